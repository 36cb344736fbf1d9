"""Exact dedup by content-defined chunk recipes (operator 11, DataFrame only).

Texts count as equal when they are the same after every run of white space
(space, tab to carriage return) has become one space.  A text is cut into
chunks of words: a rolling hash over ``WINDOW`` words proposes a boundary where
it is 0 modulo ``DIVISOR``; a proposal less than ``LEAST`` words after the one
before is passed over, a chunk of more than ``MOST`` words is cut every
``MOST``, and one of more than ``MOST_CHARS`` characters every ``MOST_CHARS``.
Every chunk ends in a space, so the chunks of a text, put together, are the
text and one space, and equal texts are those with equal lists of chunks.

1. Each distinct chunk is shuffled once, after a map-side combine (a chunk that
   fills a map task crosses once).  That verifies the identifiers: a digest may
   stand for one chunk text only.  Should one stand for two, all identifiers
   are made with the next, longer digest and verified again.
2. A document is then its recipe, the ordered list of verified identifiers
   (16 bytes for some 400 of text), written once.
3. Recipes are grouped by the whole list, also with a map-side combine.  Of
   each group only its least row and its size are kept.  Rows find their group
   in a join of two written tables, which can split a group that holds a third
   of all rows.

Long documents move once, as chunks; nothing is gathered per chunk or group.

Defined results: a NULL text is an empty one, and an empty one equals a text
of nothing; a NULL key counts as the largest, so a row with a NULL key stays
only where all keys of its group are NULL; of rows that are equal in text and
key one stays; an empty table gives an empty result; other columns pass
through, those named like an added one give way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, quoted

SPACE = r"[\x20\x09-\x0D]+"
WINDOW, DIVISOR = 2, 64
#: Words in a chunk, at least (but for the last one) and at most, and characters at most.
LEAST, MOST, MOST_CHARS = 16, 512, 8192
MADE = ("keep_id", "group_size", "kept", "text_sha256")


def hex_digest(kind: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda c: F.unhex(kind(c))


#: Identifiers of a chunk, the first of which serves unless two chunks share one.
DIGESTS: tuple[Callable[[Column], Column], ...] = (
    hex_digest(F.md5), hex_digest(lambda c: F.sha2(c, 256)), hex_digest(lambda c: F.sha2(c, 512)))


def words_of(text: Column) -> Column:
    """The text split at its runs of white space; joined by one space it is the normalised text."""
    return F.split(F.coalesce(text, F.lit("")), SPACE, -1)


def chunked(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` without the text, plus ``__xd_words`` and ``__xd_parts`` (the chunks).

    In steps, each a column of its own: what a lambda reads must not be
    computed anew for every element.
    """
    words, proposed, ends, parts = (F.col(f"__xd_{c}") for c in ("words", "proposed", "ends", "parts"))
    split = docs.withColumn("__xd_words", words_of(F.col(text))).drop(text)
    n = F.size(words)
    rolling = F.transform(words, lambda w, i: F.when(
        F.pmod(F.xxhash64(w, *[F.get(words, i - k) for k in range(1, WINDOW)]), F.lit(DIVISOR)) == 0, i + 1))
    split = split.withColumn("__xd_proposed", F.filter(rolling, lambda e: e.isNotNull()))
    far = F.filter(proposed, lambda e, j: (e < n) & (e - F.coalesce(F.get(proposed, j - 1), F.lit(0)) >= LEAST))
    split = split.withColumn("__xd_ends", F.concat(far, F.array(n)))
    starts = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
    spans = F.flatten(F.zip_with(starts, ends, lambda s, e: F.transform(
        F.sequence(s, e - 1, F.lit(MOST)), lambda a: F.struct(a.alias("s"), (F.least(a + MOST, e) - a).alias("n")))))
    split = split.withColumn("__xd_parts", F.transform(
        spans, lambda x: F.concat(F.array_join(F.slice(words, x["s"] + 1, x["n"]), " "), F.lit(" "))))
    short = F.transform(parts, lambda p: F.when(
        F.length(p) > MOST_CHARS, F.regexp_extract_all(p, F.lit("(?s).{1,%d}" % MOST_CHARS), F.lit(0))).otherwise(F.array(p)))
    long = F.exists(parts, lambda p: F.length(p) > MOST_CHARS)
    return split.withColumn("__xd_parts", F.when(long, F.flatten(short)).otherwise(parts)).drop("__xd_proposed", "__xd_ends")


def clashes(docs: DataFrame, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """(chunk): the digests that stand for more than one chunk text of the corpus."""
    # Never empty; for the plain explode a test for that would be pushed to the scan, and the chunks made there too.
    parts = chunked(docs.select(text), text).select(F.explode_outer("__xd_parts").alias("part"))
    return (parts.groupBy(digest(F.col("part")).alias("chunk"), "part").agg(F.lit(1))
            .groupBy("chunk").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("chunk"))


def verified_digest(docs: DataFrame, text: str = "text",
                    digests: Sequence[Callable[[Column], Column]] = DIGESTS) -> Callable[[Column], Column]:
    """The first of ``digests`` that tells all chunks of the corpus apart, found by comparing their bytes."""
    for digest in digests:
        if clashes(docs, text, digest).isEmpty():
            return digest
    raise ValueError("two different chunks share every digest that was given")


def recipes(docs: DataFrame, digest: Callable[[Column], Column], text: str = "text") -> DataFrame:
    """``docs`` without the text, plus ``recipe`` (identifiers in order) and ``text_sha256`` of the normalised text."""
    made = chunked(docs, text)
    return made.withColumns({
        "recipe": F.transform("__xd_parts", digest),
        "text_sha256": F.sha2(F.array_join("__xd_words", " "), 256),
    }).drop("__xd_words", "__xd_parts")


def dedup_texts(docs: DataFrame, text: str = "text", key: str = "doc_id",
                digests: Sequence[Callable[[Column], Column]] = DIGESTS) -> DataFrame:
    """``docs`` without the text, plus keep_id, group_size (bigint), kept and text_sha256."""
    rest = docs.select(*quoted([c for c in docs.columns if c.lower() not in MADE]))
    digest = verified_digest(rest, text, digests)
    # Rows are numbered before they are written, so the numbers are those of the table.
    held = rest.select(F.col(key).alias("__xd_key"), F.col(text).alias("__xd_text"),
                       F.struct(*quoted([c for c in rest.columns if c != text])).alias("__xd_rest"))
    named = cut(recipes(held, digest, "__xd_text").withColumn("__xd_row", F.monotonically_increasing_id()), "recipes")
    place = F.struct(F.col("__xd_key").isNull().alias("none"), F.col("__xd_key").alias("key"), F.col("__xd_row").alias("row"))
    groups = cut(named.groupBy("recipe").agg(F.min(place).alias("__xd_first"), F.count(F.lit(1)).alias("group_size"))
                 .filter("group_size > 1"), "recipe-groups")
    both = named.join(groups, "recipe", "left")
    alone = F.col("__xd_first").isNull()
    return both.select(
        "__xd_rest.*",
        F.when(alone, F.col("__xd_key")).otherwise(F.col("__xd_first.key")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("__xd_first.row") == F.col("__xd_row"))).alias("kept"), "text_sha256")


ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY doc_id NULLS LAST)
"""
