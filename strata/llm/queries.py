"""Registered queries of the training-data operators (one per operator) and the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, embed_dedup, exact_dedup, langid, line_dedup, lm_score, periodic, secret_scan, sharding, simhash, sp_codec, url_filter, whitening
from strata.llm.common import cut, fold, table
from strata.session import scratch_dir

QueryFn = Callable[[SparkSession, str], DataFrame]

# The list rules of operator 9, as (verdict, host, path).
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

# What tells the records of operator 7 apart: one id may stand on many rows, and equal rows are numbered.
RECORD = ["doc_id", "text_crc32", "size", "copy"]


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secret_scan.update_ledger(docs, scratch_dir(spark, "secret-ledger"))
    out = secret_scan.findings(docs, ledger)
    joined = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return out.select("doc_id", count("assign"), count("access"), count("hex"),
                      F.sha2(joined, 256).alias("base_sha256"), joined.alias("spans"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_shards = 16
    docs = table(spark, sf_dir, "documents")
    records = cut(sharding.numbered(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("text_crc32")))
        .withColumn("vslot", sharding.slot_of(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in RECORD]))), "shard-records")
    load = cut(sharding.slot_bytes(records), "slot-bytes")
    maps = scratch_dir(spark, "slot-map")
    first = sharding.store_map(sharding.even_map(spark, n_shards), maps, 0)
    edited = sharding.store_map(sharding.balance(first, load, n_shards), maps, 1)
    placed = sharding.assign(records, edited, RECORD)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "vslot")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_score.score(docs, fold(F.col("doc_id"), 5) == 1)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", url_filter.junk_outcome(F.col("html")).alias("bad"))
    out = url_filter.filter_urls(pages, F.col("bad"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict",
                      F.round("mean", 6).alias("bad_rate"), F.round("bound", 6).alias("bad_bound"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def vocabulary(spark: SparkSession) -> sp_codec.Vocabulary:
    """The vocabulary file named by ``strata.llm.sentencepiece.model`` (default: the public merge model)."""
    return sp_codec.read_model(spark.conf.get("strata.llm.sentencepiece.model", sp_codec.MODEL_PATH))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sp_codec.encode_column(docs, vocabulary(spark)).select("doc_id", "ids", "n_tokens", "n_byte_tokens", "round_trip")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    net = langid.learn(docs, ~held_out)
    return (langid.identify(docs.select("doc_id", "text"), net)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "lang_share"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontam.overlaps(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return out.select("doc_id", (F.size("matches") > 0).alias("contaminated"), items.alias("item_ids"), "matches")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def rewritten(docs: DataFrame) -> DataFrame:
    """``docs`` in which the tail of about a tenth of the texts, chosen by id, repeats its own first words.

    A row without an id keeps its text.
    """
    h, words, n = F.col("__h"), F.col("__words"), F.size("__words")
    g = F.floor(h / 10)
    chosen = docs.withColumn("__h", F.crc32(F.col("doc_id").cast("string")))
    chosen = chosen.withColumn("__words", F.when(h % 10 == 0, F.filter(F.split("text", exact_dedup.SPACE, -1), lambda w: w != "")))
    chosen = chosen.withColumn("__a", F.when(n > 0, g % n).cast("int"))
    chosen = chosen.withColumn("__p", (1 + F.floor((n - F.col("__a")) / (3 + g % 8))).cast("int"))
    a, p = F.col("__a"), F.col("__p")
    tail = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p)))
    return chosen.withColumn("text", F.when(p.isNotNull(), F.array_join(tail, " ")).otherwise(F.col("text"))).drop("__h", "__words", "__a", "__p")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.periodic_runs(rewritten(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    out = out.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                     F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
    return out.select("doc_id", "n_runs", (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.q")).alias("period"),
                      F.expr("1000 * best.length div -best.q").alias("exponent_milli"), "runs_sha256", "collapsed_sha256", "n_words")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return out.select("vec_id", "fit_rows", "deviation", "identity_error", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.col("fit_rows").alias("n"), "deviation",
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (op1_line_dedup, op2_secret_scan, op3_sentencepiece, op4_language_id, op5_simhash_dedup, op6_benchmark_decontamination, op7_sharding, op8_lm_scoring, op9_url_filter, op10_embedding_dedup, op11_exact_dedup, op12_periodic_runs, op13_embedding_whitening)}

ORACLES: dict[str, str] = {"op1_line_dedup": line_dedup.ORACLE, "op11_exact_dedup": exact_dedup.ORACLE, "op9_url_filter": url_filter.oracle(URL_RULES)}
