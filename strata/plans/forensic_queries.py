"""Registered queries: fixed-width files, file inventory, health, salvage, token scans.

Test lakes are written from the benchmark tables by Spark tasks; which damage
or magic a file gets is decided by the data it holds (the region of its
survey, or the reading's flag), so expected results can be stated in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import convert as CV
from strata.operators import forensics as FX
from strata.operators import marts as M
from strata.plans import fixtures as FIX
from strata.plans.joins import maybe_broadcast
from strata.plans.registry import LOAD_TS, register
from strata.plans.vault_queries import TS_SQL, _with
from strata.session import scratch_dir
from strata.sinks import files as SF
from strata.sinks import fixedwidth as FWE
from strata.sinks import trace_writer as TW
from strata.sources import analog
from strata.sources import fixedwidth as FW
from strata.streaming import trace_stream as TS

# Damage given to the Parquet files of each region key in test lakes.
DAMAGE_BY_REGION = ("healthy", "trailing_junk", "junk_with_par1", "wrong_footer_len", "healthy")

F32_READINGS_SQL = """
SELECT survey_id, well_id, CAST(CAST(depth AS FLOAT) AS DOUBLE) AS depth,
       CAST(CAST(amplitude AS FLOAT) AS DOUBLE) AS amplitude, quality_flag
FROM readings"""


def _encoded_lake(spark, sf_dir, name, **kw) -> str:
    out = scratch_dir(spark, name)
    r = FWE.readings_frame(analog.readings(spark, sf_dir))
    FWE.written(FWE.encode(r, out, **kw))
    return out


@register("fixedwidth_scan", _with(F32_READINGS_SQL))
def q_fixedwidth_scan(spark, sf_dir):
    """Readings encoded as fixed-width files by Spark tasks, decoded by the data source."""
    lake = _encoded_lake(spark, sf_dir, "sgx")
    df = FW.read(spark, lake, recordsPerSplit=100_000, openCostRecords=1000)
    return df.select("survey_id", "well_id", "depth", "amplitude", "quality_flag")


@register("fixedwidth_write", _with(F32_READINGS_SQL))
def q_fixedwidth_write(spark, sf_dir):
    """Readings through the trace-file write format: an append, then the same again by an overwrite, then read back."""
    lake = scratch_dir(spark, "trace-write")
    r = FWE.readings_frame(analog.readings(spark, sf_dir))
    TW.write(r, lake)
    TW.write(r, lake, mode="overwrite", bufferBytes=1 << 20)
    return FW.read(spark, lake, openCostRecords=1000).select("survey_id", "well_id", "depth", "amplitude", "quality_flag")


@register("fixedwidth_stream", _with(F32_READINGS_SQL))
def q_fixedwidth_stream(spark, sf_dir):
    """Trace files arrive in two drops; the stream decodes each file once, and a third run finds nothing new."""
    base = scratch_dir(spark, "trace-stream")
    r = analog.readings(spark, sf_dir)
    flagged = F.coalesce(F.col("quality_flag"), F.lit(0)) == 1
    for drop in (~flagged, flagged, None):
        if drop is not None:
            TW.write(FWE.readings_frame(r.where(drop)), f"{base}/lake")
        TS.convert_arrivals(spark, f"{base}/lake", f"{base}/arrivals", f"{base}/readings", f"{base}/checkpoint")
    out = spark.read.parquet(f"{base}/readings")
    return out.select(F.col("survey_id").cast("bigint").alias("survey_id"), "well_id", "depth", "amplitude", "quality_flag")


@register("fixedwidth_truncated", _with(F32_READINGS_SQL))
def q_fixedwidth_truncated(spark, sf_dir):
    """Over-stated counts with a cut last record, and junk past the count: full records only."""
    out = scratch_dir(spark, "sgx-trunc")
    r = FWE.readings_frame(analog.readings(spark, sf_dir))
    flagged = F.coalesce(F.col("quality_flag"), F.lit(0)) == 1
    FWE.written(FWE.encode(r.where(~flagged), out + "/cut", count_delta=3, tail=b"\x07" * 7))
    FWE.written(FWE.encode(r.where(flagged), out + "/junk", tail=b"JUNK" * 10))
    df = FW.read(spark, out, recordsPerSplit=100_000, openCostRecords=1000)
    return df.select("survey_id", "well_id", "depth", "amplitude", "quality_flag")


@register("fixedwidth_inspect", _with("""
SELECT 'ok' AS status, survey_id, count(*) AS records_readable FROM readings
WHERE coalesce(quality_flag, 0) = 0 GROUP BY survey_id
UNION ALL
SELECT 'bad_magic', NULL, 0 FROM readings WHERE quality_flag = 1 HAVING count(*) > 0"""))
def q_fixedwidth_inspect(spark, sf_dir):
    """Per-file header report: flagged readings were written with a wrong magic."""
    lake = _encoded_lake(spark, sf_dir, "sgx-inspect", group_col="quality_flag",
                         magic_when={1: b"CPETRO02"})
    rep = FW.inspect(spark, lake, filesPerSplit=16)
    return (rep.groupBy("status", "survey_id")
               .agg(F.sum("records_readable").cast("bigint").alias("records_readable")))


@register("fixedwidth_convert", _with(f"""
SELECT survey_id, well_id, CAST(CAST(depth AS FLOAT) AS DOUBLE) AS depth,
       CAST(CAST(amplitude AS FLOAT) AS DOUBLE) AS amplitude, quality_flag,
       '{LOAD_TS}' AS ingest_timestamp
FROM readings"""))
def q_fixedwidth_convert(spark, sf_dir):
    """Decode a lake and store it as one Parquet table partitioned by survey."""
    lake = _encoded_lake(spark, sf_dir, "sgx-convert")
    out = scratch_dir(spark, "converted")
    res = CV.convert_lake(spark, lake, out, LOAD_TS, recordsPerSplit=100_000, openCostRecords=1000)
    return res["readings"].select("survey_id", "well_id", "depth", "amplitude", "quality_flag",
                                  "ingest_timestamp")


# ---- Parquet lakes --------------------------------------------------------------

def _readings_with_region(spark, sf_dir) -> DataFrame:
    s = analog.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = analog.table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    sk = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left") \
          .select(F.col("s_suppkey").cast("bigint").alias("survey_id"), "n_regionkey")
    r = analog.readings(spark, sf_dir)
    damage = F.element_at(F.array(*[F.lit(x) for x in DAMAGE_BY_REGION]),
                          F.coalesce(F.col("n_regionkey"), F.lit(0)) + 1)
    return (r.join(maybe_broadcast(sk, bound_source=s), "survey_id", "left")
             .withColumn("damage", F.coalesce(damage, F.lit("healthy"))).drop("n_regionkey"))


DAMAGE_SQL = ("coalesce(CASE coalesce(n_regionkey, 0) " +
              " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DAMAGE_BY_REGION)) +
              " END, 'healthy')")
READINGS_DAMAGE_CTE = f""",
rd AS (
  SELECT r.*, {DAMAGE_SQL} AS damage
  FROM readings r LEFT JOIN supplier ON r.survey_id = s_suppkey
                  LEFT JOIN nation ON s_nationkey = n_nationkey)
"""


def _damaged_lake(spark, sf_dir, name):
    """Readings written as Parquet files per region damage kind, flagged ones under hidden names; then damaged copies."""
    clean, lake = scratch_dir(spark, name + "-clean"), scratch_dir(spark, name)
    staged = _readings_with_region(spark, sf_dir)
    flagged = F.coalesce(F.col("quality_flag"), F.lit(0)) == 1
    written = SF.stored(SF.write_parquet_groups(staged.where(~flagged), clean, group_col="damage", suffix=".parquet")
                        .unionByName(SF.write_parquet_groups(staged.where(flagged), clean, group_col="damage",
                                                             suffix=".parquet", prefix="_part")))
    copies = SF.stored(FIX.damage_files(written, lake, clean))
    per_file = copies.join(written.select(F.col("path").alias("source"), "group_key", "rows"), "source")
    return lake, per_file.select(FX.plain_path(F.col("path")).alias("path"), "group_key", "rows")


@register("file_inventory", _with("""
SELECT 'parquet' AS kind, count(*) AS row_count FROM readings WHERE coalesce(quality_flag, 0) = 0
UNION ALL SELECT 'sgx', count(*) FROM readings WHERE quality_flag = 1"""))
def q_file_inventory(spark, sf_dir):
    """Files of two kinds (and decoys) found by suffix, hidden names among them; rows per kind from the manifests."""
    lake = scratch_dir(spark, "inventory")
    r = analog.readings(spark, sf_dir)
    flagged = F.coalesce(F.col("quality_flag"), F.lit(0)) == 1
    deep = F.coalesce(F.col("depth"), F.lit(0)) > 25
    made = [SF.write_parquet_groups(r.where(~flagged & ~deep), lake + "/parquet", suffix=".parquet"),
            SF.write_parquet_groups(r.where(~flagged & deep), lake + "/_hidden", suffix=".parquet", prefix=".part")]
    sgx = FWE.encode(FWE.readings_frame(r.where(flagged)), lake + "/sgx").where("path is not null").select("path", "rows")
    rows = SF.stored(made[0].unionByName(made[1]).select("path", "rows").unionByName(sgx))
    region = analog.table(spark, sf_dir, "region")
    SF.stored(SF.write_parquet_groups(region, lake + "/decoy", suffix=".PARQUET")
              .unionByName(SF.write_parquet_groups(region, lake + "/decoy", suffix=".sgx.bak")))
    inv = FX.list_files(spark, lake, "*.parquet").withColumn("kind", F.lit("parquet")) \
        .unionByName(FX.list_files(spark, lake, "*.sgx").withColumn("kind", F.lit("sgx")))
    per_file = (inv.select(FX.plain_path(F.col("path")).alias("path"), "kind")
                .join(rows.withColumn("path", FX.plain_path(F.col("path"))), "path", "left"))
    return per_file.groupBy("kind").agg(F.sum("rows").cast("bigint").alias("row_count"))


@register("file_health", "WITH " + analog.ANALOG_CTES + READINGS_DAMAGE_CTE + """
SELECT damage, CASE damage WHEN 'healthy' THEN 'plausible' WHEN 'trailing_junk' THEN 'no_tail_magic'
                           WHEN 'junk_with_par1' THEN 'no_tail_magic'
                           WHEN 'wrong_footer_len' THEN 'bad_footer_len' END AS state,
       count(*) AS row_count
FROM rd GROUP BY damage""")
def q_file_health(spark, sf_dir):
    """State of each damaged file from its edge bytes; rows per damage kind and state."""
    lake, written = _damaged_lake(spark, sf_dir, "health")
    health = FX.parquet_health(FX.file_edges(FX.list_files(spark, lake, "*.parquet")))
    per_file = health.withColumn("path", FX.plain_path(F.col("path"))).join(written, "path")
    return (per_file.groupBy(F.col("group_key").alias("damage"), "state")
                    .agg(F.sum("rows").cast("bigint").alias("row_count")))


@register("file_salvage", _with(f"""
SELECT survey_id, well_id, depth, amplitude, quality_flag,
       strftime(ingest_timestamp, {TS_SQL}) AS ingest_timestamp
FROM readings"""))
def q_file_salvage(spark, sf_dir):
    """Damaged lake salvaged file by file; every recovered row read back."""
    lake, _ = _damaged_lake(spark, sf_dir, "salvage")
    out = scratch_dir(spark, "salvaged")
    report = SF.stored(FX.salvage(FX.list_files(spark, lake, "*.parquet"), out))
    df = FX.recovered(report, lake, out, analog.readings(spark, sf_dir).schema)
    return df.select("survey_id", "well_id", "depth", "amplitude", "quality_flag",
                     M.ts_text(F.col("ingest_timestamp")).alias("ingest_timestamp"))


@register("file_salvage_report", "WITH " + analog.ANALOG_CTES + READINGS_DAMAGE_CTE + """
SELECT damage, CASE damage WHEN 'healthy' THEN 'healthy' ELSE 'repaired' END AS status,
       CASE damage WHEN 'healthy' THEN 'healthy' WHEN 'wrong_footer_len' THEN 'footer_length'
                   ELSE 'trimmed' END AS method,
       count(*) AS row_count
FROM rd GROUP BY damage""")
def q_file_salvage_report(spark, sf_dir):
    """Salvage outcome per damage kind: status, method and rows recovered."""
    lake, written = _damaged_lake(spark, sf_dir, "salvage-report")
    report = FX.salvage(FX.list_files(spark, lake, "*.parquet"), scratch_dir(spark, "salvaged"))
    per_file = report.withColumn("path", FX.plain_path(F.col("path"))).join(written.select("path", "group_key"), "path")
    return (per_file.groupBy(F.col("group_key").alias("damage"), "status", "method")
                    .agg(F.sum("rows").cast("bigint").alias("row_count")))


# ---- token scans ---------------------------------------------------------------------

TOKEN_FILTER_SQL = "lambda x: contains(x, 'CTF') OR contains(x, 'flag') OR contains(x, '{')"


@register("token_scan_text", f"""
SELECT page_id, unnest(list_filter(regexp_extract_all(html, '{FX.TOKEN_PATTERN}'), {TOKEN_FILTER_SQL}))
       AS token
FROM pages""")
def q_token_scan_text(spark, sf_dir):
    """Suspicious tokens in every page's whole HTML, one row per hit."""
    pages = analog.pages(spark, sf_dir)
    return FX.token_hits(pages, ["page_id"], "html").select("page_id", "token")


@register("token_scan_tail", f"""
SELECT page_id, unnest(list_filter(regexp_extract_all(t, '{FX.TOKEN_PATTERN}'), {TOKEN_FILTER_SQL}))
       AS token
FROM (SELECT page_id,
             regexp_replace(CAST(encode(html)[-{FX.DEFAULT_TAIL_BYTES}:] AS VARCHAR),
                            '\\\\x[0-9A-F]{{2}}', ' ', 'g') AS t
      FROM pages)""")
def q_token_scan_tail(spark, sf_dir):
    """Each page stored as a file, every other under a hidden name; the last 2,000 bytes of every file are scanned."""
    lake = scratch_dir(spark, "pages")
    pages = analog.pages(spark, sf_dir)
    hidden = F.when(F.col("page_id") % 2 == 0, ".").otherwise("")
    named = pages.select(F.concat(hidden, F.format_string("page-%d.html", "page_id")).alias("name"), "html")
    SF.stored(SF.write_text_files(named, lake, "name", "html"))
    hits = FX.token_scan_files(spark, lake, "*.html")
    return hits.select(F.regexp_extract("path", r"page-(\d+)\.html$", 1).cast("bigint").alias("page_id"),
                       "token")
