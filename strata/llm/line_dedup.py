"""Line dedup by content-defined line chunks (operator 1, DataFrame only).

A text is cut into chunks of whole lines.  A rolling hash over ``WINDOW`` line
hashes proposes a boundary where it is 0 modulo ``DIVISOR``; of neighbouring
proposals only the first counts, so every chunk has at least two lines, and
since a boundary depends on a few lines before it alone, chunks realign after
an insertion.  A chunk of two or more lines that occurs more than once in the
corpus stays at its first place (lowest doc_id, text digest, position) and is
removed everywhere else.  Chunks meet by digest, and only where all texts of a
digest are the same bytes is anything removed.

Defined results: a NULL text stays NULL and an empty one empty; a text of one
line is never touched; rows equal in doc_id and text are one document and keep
the same lines; a NULL doc_id sorts first; a text of which nothing is left
becomes empty; other columns pass through.

``dedup_lines`` removes chunks only, so of a repeated passage no more than the
chunks inside it.  ``dedup_passages`` finds the rest, by digest and after the same byte comparison: besides the chunks it removes every passage of two or more lines with words and over
``PASSAGE_WORDS`` words that stands at an earlier place.  From each line with
words run the shortest such passage forwards and the shortest backwards; any
repeated passage is the union of those inside it, and they end where the text
says, so equal passages give equal spans wherever they stand.  Blank lines
count for nothing but are part of the text.  A place that overlaps its own
first place loses only the lines beyond it.  The first of equal lines in the
corpus always stays, since an earlier passage would hold an earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, quoted

DIVISOR = 3
#: Multiplier of the older line's hash in the rolling hash of two lines.
FACTOR = 31
#: A repeated passage has more words (runs without white space) than this, and two lines with words.
PASSAGE_WORDS = 50
#: Packs two line numbers into one bigint.
SHIFT = 1 << 32
MADE = ("n_lines", "removed_chunks", "removed_lines")


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``__ld_rows`` (lines), ``__ld_spans`` (first line, from 1, and line count of each chunk) and ``__ld_doc`` (text digest)."""
    lined = docs.withColumns({"__ld_rows": F.split(F.col(text), "\n", -1), "__ld_doc": F.md5(text)})
    lined = lined.withColumns({"__ld_hash": F.transform("__ld_rows", line_hash), "__ld_n": F.size("__ld_rows")})
    n, h = F.col("__ld_n"), F.col("__ld_hash")
    # Proposals for "a boundary after line i", i = 2 .. n.
    proposed = F.zip_with(F.slice(h, 2, n - 1), F.slice(h, 1, n - 1),
                          lambda new, old: (new + FACTOR * old) % DIVISOR == 0)
    lined = lined.withColumn("__ld_prop", F.when(n > 0, proposed))
    p = F.col("__ld_prop")
    first = F.zip_with(p, F.concat(F.array(F.lit(False)), F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0)))),
                       lambda now, before: now & ~F.coalesce(before, F.lit(False)))
    inner = F.filter(F.transform(first, lambda b, i: F.when(b & (i + 2 <= n - 2), i + 2)), lambda e: e.isNotNull())
    lined = lined.withColumn("__ld_ends", F.concat(inner, F.array(n)))
    ends = F.col("__ld_ends")
    starts = F.concat(F.array(F.lit(1)), F.transform(F.slice(ends, 1, F.size(ends) - 1), lambda e: e + 1))
    spans = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), (e - s + 1).alias("n")))
    return lined.withColumn("__ld_spans", spans).drop("__ld_hash", "__ld_n", "__ld_prop", "__ld_ends")


def with_chunks(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``__ld_parts`` (chunk texts), ``__ld_lines`` (their line counts) and ``__ld_doc`` (text digest)."""
    lined = with_spans(docs, text)
    rows = F.col("__ld_rows")
    return lined.withColumns({
        "__ld_parts": F.transform("__ld_spans", lambda x: F.array_join(F.slice(rows, x["s"], x["n"]), "\n")),
        "__ld_lines": F.transform("__ld_spans", lambda x: x["n"]),
    }).drop("__ld_rows", "__ld_spans")


def repeated_chunks(chunked: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, __ld_doc, gone): the positions of the chunks to remove, for documents that lose any.

    Two shuffles: chunk texts with a map-side combine (a chunk that fills a
    map task crosses once), for the byte comparison; and rows of digests and
    positions, to find the first place.  Nothing is gathered per chunk, so a
    chunk that a third of all documents share makes no large group; its rows
    meet their first place in a join of two written tables, which can split it.
    """
    digest = F.unhex(F.md5("part")).alias("chunk")
    one = chunked.select(key, "__ld_doc", F.posexplode(F.arrays_zip(F.col("__ld_parts").alias("part"), F.col("__ld_lines").alias("n"))).alias("ord", "c"))
    one = one.select(key, "__ld_doc", "ord", F.col("c.part").alias("part"), F.col("c.n").alias("n")).filter("n > 1")
    equal = (one.groupBy(digest, "part").count()
             .groupBy("chunk").agg(F.count("*").alias("texts"), F.sum("count").alias("times"))
             .filter("times > 1 and texts = 1").select("chunk"))
    places = cut(one.select(key, F.unhex("__ld_doc").alias("doc"), "ord", digest), "chunk-places")
    first = (places.groupBy("chunk").agg(F.min(F.struct(key, "doc", "ord")).alias("first"), F.count("*").alias("times"))
             .filter("times > 1").select("chunk", "first").join(equal, "chunk"))
    first = cut(first, "chunk-firsts")
    gone = places.join(first, "chunk").filter(~F.struct(key, "doc", "ord").eqNullSafe(F.col("first")))
    return (gone.groupBy(key, "doc").agg(F.collect_set("ord").alias("gone"))
            .select(F.col(key).alias("__ld_key"), F.lower(F.hex("doc")).alias("__ld_of"), F.col("gone").alias("__ld_gone")))


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with repeated chunks cut from the text, plus n_lines, removed_chunks, removed_lines (bigint).

    Existing columns of those three names give way.
    """
    chunked = with_chunks(docs, text).drop(text)
    gone = repeated_chunks(with_chunks(docs.select(key, text), text), key)
    both = chunked.join(gone, chunked[key].eqNullSafe(gone["__ld_key"]) & (chunked["__ld_doc"] == gone["__ld_of"]), "left")
    parts, lines = F.col("__ld_parts"), F.col("__ld_lines")
    lost = F.coalesce("__ld_gone", F.array().cast("array<int>"))
    kept = F.array_except(F.when(parts.isNotNull(), F.sequence(F.lit(0), F.size(parts) - 1)), lost)
    total = F.aggregate(lines, F.lit(0), lambda a, x: a + x)
    return both.withColumns({
        text: F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"),
        "n_lines": F.coalesce(total, F.lit(0)).cast("bigint"),
        "removed_chunks": F.size(lost).cast("bigint"),
        "removed_lines": F.aggregate(F.transform(lost, lambda i: F.get(lines, i)), F.lit(0), lambda a, x: a + x).cast("bigint"),
    }).select(*quoted([c for c in docs.columns if c.lower() not in MADE]), *MADE)


def passage_spans(rows: Column, full: Column) -> Column:
    """Packed (first line, line count) of the shortest passages; ``full`` holds position and words of the lines with words."""
    most = PASSAGE_WORDS + 1  # lines with words that a shortest passage can have

    def enough(a: Column) -> Column:
        return (a["n"] >= 2) & (a["w"] > PASSAGE_WORDS)

    def shortest(lines: Column) -> Column:
        return F.aggregate(lines, F.struct(F.lit(0).alias("n"), F.lit(0).alias("w")),
                           lambda a, x: F.when(enough(a), a).otherwise(F.struct((a["n"] + 1).alias("n"), (a["w"] + x["w"]).alias("w"))),
                           lambda a: F.when(enough(a), a["n"]))

    def packed(first: Column, last: Column) -> Column:
        return (first + 1).cast("bigint") * SHIFT + (last - first + 1)

    forwards = F.transform(full, lambda x, i: packed(x["i"], F.get(full, i + shortest(F.slice(full, i + 1, F.lit(most))) - 1)["i"]))
    backwards = F.transform(full, lambda x, i: packed(
        F.get(full, i - shortest(F.reverse(F.slice(full, F.greatest(i + 2 - most, F.lit(1)), F.least(i + 1, F.lit(most))))) + 1)["i"], x["i"]))
    return F.filter(F.concat(forwards, backwards), lambda c: c.isNotNull())


def span_digest(span: Column) -> Column:
    """What spans meet by: the first half of their text's SHA-256."""
    return F.unhex(F.substring(F.sha2(span, 256), 1, 32))


def same_bytes(docs: DataFrame, places: DataFrame, text: str, key: str) -> DataFrame:
    """(span): the digests among ``places`` of which all texts are the same bytes.

    The texts are cut out of the documents again, of these places alone, and
    combined in the map tasks, so a passage crosses once per task.
    """
    wanted = places.groupBy(key, "doc").agg(F.collect_set(F.struct("s", "n", "span")).alias("__ld_at"))
    wanted = wanted.select(F.col(key).alias("__ld_key"), F.lower(F.hex("doc")).alias("__ld_of"), "__ld_at")
    named = docs.select(key, F.col(text).alias("__ld_text"), F.md5(text).alias("__ld_doc"))
    both = named.join(wanted, named[key].eqNullSafe(wanted["__ld_key"]) & (named["__ld_doc"] == wanted["__ld_of"]))
    cut_out = F.transform("__ld_at", lambda c: F.struct(c["span"].alias("span"), F.array_join(F.slice("__ld_rows", c["s"] + 1, c["n"]), "\n").alias("part")))
    parts = both.select(F.split("__ld_text", "\n", -1).alias("__ld_rows"), "__ld_at").select(F.explode(cut_out).alias("c"))
    return (parts.groupBy("c.span", "c.part").count()
            .groupBy("span").agg(F.count("*").alias("texts")).filter("texts = 1").select("span"))


def repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(__ld_key, __ld_of, __ld_gone): the packed first and last lines, from 0, to remove, for documents that lose any.

    Spans meet by ``span_digest``, so only the texts of repeated ones are
    shuffled, for the byte comparison; as with chunks nothing is gathered per
    span, and both sides of the join on spans are written tables, so a hot
    span can be split.
    """
    rows = F.col("__ld_rows")
    counted = F.transform(rows, lambda r, i: F.struct(i.alias("i"), F.regexp_count(r, F.lit(r"\S+")).alias("w")))
    lined = with_spans(docs.select(key, text), text).withColumn("__ld_full", F.filter(counted, lambda x: x["w"] > 0))
    chunks = F.transform(F.filter("__ld_spans", lambda x: x["n"] > 1), lambda x: x["s"].cast("bigint") * SHIFT + x["n"])
    lined = lined.withColumn("__ld_all", F.array_distinct(F.concat(chunks, passage_spans(rows, F.col("__ld_full")))))
    # Texts are hashed before the spans become rows: a row holds no lines.
    spans = F.transform("__ld_all", lambda c: F.struct(
        (F.shiftright(c, 32).cast("int") - 1).alias("s"), (c % SHIFT).cast("int").alias("n"),
        span_digest(F.array_join(F.slice(rows, F.shiftright(c, 32).cast("int"), (c % SHIFT).cast("int")), "\n")).alias("span")))
    one = lined.select(key, F.unhex("__ld_doc").alias("doc"), F.explode(spans).alias("c"))
    places = cut(one.select(key, "doc", "c.s", "c.n", "c.span"), "span-places")
    own = F.struct(key, "doc", "s")
    first = places.groupBy("span").agg(F.min(own).alias("first"), F.count("*").alias("times")).filter("times > 1").select("span", "first")
    first = cut(first, "span-firsts")
    equal = same_bytes(docs, places.join(first.select("span"), "span"), text, key)
    first = cut(first.join(equal, "span"), "span-equals")
    gone = places.join(first, "span").filter(~own.eqNullSafe(F.col("first")))
    same = F.col(key).eqNullSafe(F.col("first")[key]) & (F.col("doc") == F.col("first.doc"))
    start = F.when(same, F.greatest(F.col("s"), F.col("first.s") + F.col("n"))).otherwise(F.col("s"))
    return (gone.groupBy(key, "doc").agg(F.collect_set(start.cast("bigint") * SHIFT + F.col("s") + F.col("n") - 1).alias("gone"))
            .select(F.col(key).alias("__ld_key"), F.lower(F.hex("doc")).alias("__ld_of"), F.col("gone").alias("__ld_gone")))


def dedup_passages(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with repeated passages and chunks cut from the text, plus n_lines and removed_lines (bigint).

    Existing columns of those two names give way.
    """
    made = ("n_lines", "removed_lines")
    gone = repeated_lines(docs, text, key)
    named = docs.withColumn("__ld_doc", F.md5(text))
    both = named.join(gone, named[key].eqNullSafe(gone["__ld_key"]) & (named["__ld_doc"] == gone["__ld_of"]), "left")
    both = both.withColumn("__ld_rows", F.split(F.col(text), "\n", -1))
    runs = F.transform("__ld_gone", lambda c: F.sequence(F.shiftright(c, 32).cast("int"), (c % SHIFT).cast("int")))
    both = both.withColumn("__ld_lost", F.coalesce(F.array_distinct(F.flatten(runs)), F.array().cast("array<int>")))
    rows, lost = F.col("__ld_rows"), F.col("__ld_lost")
    kept = F.array_except(F.sequence(F.lit(0), F.size(rows) - 1), lost)
    return both.withColumns({
        text: F.when(F.size(lost) > 0, F.array_join(F.transform(kept, lambda i: F.get(rows, i)), "\n")).otherwise(F.col(text)),
        "n_lines": F.coalesce(F.when(rows.isNotNull(), F.size(rows)), F.lit(0)).cast("bigint"),
        "removed_lines": F.size(lost).cast("bigint"),
    }).select(*quoted([c for c in docs.columns if c.lower() not in made]), *made)


ORACLE = f"""
WITH d AS (SELECT DISTINCT doc_id, text, md5(text) AS dm FROM documents),
l AS (SELECT doc_id, dm, unnest(string_split(text, chr(10))) AS ln, generate_subscripts(string_split(text, chr(10)), 1) AS i,
             len(string_split(text, chr(10))) AS n FROM d WHERE text IS NOT NULL),
h AS (SELECT *, ('0x' || substr(md5(ln), 1, 8))::BIGINT AS hv FROM l),
c AS (SELECT *, coalesce((hv + {FACTOR} * lag(hv) OVER w) % {DIVISOR} = 0, false) AS p FROM h WINDOW w AS (PARTITION BY doc_id, dm ORDER BY i)),
b AS (SELECT *, p AND NOT coalesce(lag(p) OVER w, false) AND i <= n - 2 AS b FROM c WINDOW w AS (PARTITION BY doc_id, dm ORDER BY i)),
o AS (SELECT *, coalesce(sum(b::INT) OVER (PARTITION BY doc_id, dm ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ord FROM b),
parts AS (SELECT doc_id, dm, ord, count(*) AS nl, string_agg(ln, chr(10) ORDER BY i) AS t FROM o GROUP BY ALL),
r AS (SELECT *, nl > 1 AND row_number() OVER (PARTITION BY t, nl > 1 ORDER BY doc_id NULLS FIRST, dm, ord) > 1 AS gone FROM parts),
s AS (SELECT doc_id, dm, sum(nl) AS n_lines, count_if(gone) AS rc, coalesce(sum(nl) FILTER (gone), 0) AS rl,
             coalesce(string_agg(t, chr(10) ORDER BY ord) FILTER (NOT gone), '') AS clean FROM r GROUP BY ALL)
SELECT x.doc_id, s.clean AS text, coalesce(s.n_lines, 0)::BIGINT AS n_lines, coalesce(s.rc, 0)::BIGINT AS removed_chunks,
       coalesce(s.rl, 0)::BIGINT AS removed_lines
FROM documents x LEFT JOIN s ON x.doc_id IS NOT DISTINCT FROM s.doc_id AND md5(x.text) = s.dm
"""
