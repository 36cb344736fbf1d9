"""Registered queries: incremental loads, schema drift and the file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import incremental as INC
from strata.operators.marts import ts_text
from strata.operators.vault import build_hub, build_vault, seismic_sat
from strata.plans.registry import LOAD_TS, register
from strata.plans.vault_queries import SRC_HASH_SQL, TS_SQL, _with
from strata.session import scratch_dir
from strata.sources import analog
from strata.streaming import drift_stream as DS
from strata.streaming.incremental_stream import load_readings_stream

# Fixed cut between the two arrivals of the stream query.
STREAM_CUT = "1998-07-01"


# Load date of readings without a timestamp; they arrive last.
UNDATED = "undated"


def yearly_batches(readings: DataFrame, column: str = "ingest_timestamp") -> list[tuple[str, DataFrame]]:
    """(load date, readings) by year, and last the readings without a timestamp.

    Years are half-open timestamp ranges, which reach the Parquet scan as
    pushed filters; only the first and last timestamp come to the driver.
    """
    first, last = readings.agg(F.min(column), F.max(column)).first()
    out = []
    for y in range(first.year, last.year + 1) if first is not None else ():
        lo, hi = (F.lit(f"{n:04d}-01-01").cast("timestamp_ntz") for n in (y, y + 1))
        out.append((str(y), readings.where((F.col(column) >= lo) & (F.col(column) < hi))))
    return [*out, (UNDATED, readings.where(F.col(column).isNull()))]


def with_gaps(readings: DataFrame) -> DataFrame:
    """Readings of which every tenth survey has lost its timestamps, and every seventh well its id."""
    ts = F.when(F.col("survey_id") % 10 != 0, F.col("ingest_timestamp"))
    well = F.when(F.col("well_id") % 7 != 0, F.col("well_id"))
    return readings.withColumns({"ingest_timestamp": ts, "well_id": well})


GAPS_CTE = """,
gaps AS (SELECT survey_id, CASE WHEN well_id % 7 <> 0 THEN well_id END AS well_id, depth, amplitude, quality_flag,
                CASE WHEN survey_id % 10 <> 0 THEN ingest_timestamp END AS ingest_timestamp FROM readings)
"""
FIRST_YEAR_SQL = f"coalesce(CAST(min(year(ingest_timestamp)) AS VARCHAR), '{UNDATED}') AS load_date"


@register("incremental_hub", "WITH " + analog.ANALOG_CTES + GAPS_CTE + f"""
SELECT md5(CAST(well_id AS VARCHAR)) AS hub_well_key, well_id, {FIRST_YEAR_SQL}, 'readings' AS record_source
FROM gaps WHERE well_id IS NOT NULL GROUP BY well_id""")
def q_incremental_hub(spark, sf_dir):
    """Wells hub loaded from yearly reading batches (the first twice), undated readings last: new keys only."""
    vault = INC.IncrementalVault(scratch_dir(spark, "inc-hub"))
    batches = yearly_batches(with_gaps(analog.readings(spark, sf_dir)))
    for date, rows in [batches[0], *batches]:
        vault.load(spark, {"hub_well": build_hub(rows, "well_id", "hub_well_key", date, "readings")})
    return vault.table(spark, "hub_well")


@register("incremental_sat", "WITH " + analog.ANALOG_CTES + GAPS_CTE + f"""
SELECT link_survey_well_key, depth, amplitude, quality_flag, source_hash,
       strftime(min(ingest_timestamp), {TS_SQL}) AS ingest_timestamp, {FIRST_YEAR_SQL}
FROM (SELECT md5(CAST(survey_id AS VARCHAR) || '_' || CAST(well_id AS VARCHAR)) AS link_survey_well_key,
             depth, amplitude, quality_flag, {SRC_HASH_SQL} AS source_hash, ingest_timestamp
      FROM gaps WHERE survey_id IS NOT NULL AND well_id IS NOT NULL)
GROUP BY link_survey_well_key, depth, amplitude, quality_flag, source_hash""")
def q_incremental_sat(spark, sf_dir):
    """Readings satellite by yearly batches: a row only for a change hash new to its link."""
    vault = INC.IncrementalVault(scratch_dir(spark, "inc-sat"))
    batches = yearly_batches(with_gaps(analog.readings(spark, sf_dir)))
    for date, rows in [batches[0], *batches]:
        vault.load(spark, {"sat_seismic_data": seismic_sat(rows, date, keep_source_timestamp=True, once=True)})
    return vault.table(spark, "sat_seismic_data").select(
        "link_survey_well_key", "depth", "amplitude", "quality_flag", "source_hash",
        ts_text(F.col("ingest_timestamp")).alias("ingest_timestamp"), "load_date")


@register("incremental_masters", _with(f"""
SELECT 'sat_survey_details' AS table_name, survey_type_id AS business_key, survey_type AS attribute, '1' AS load_date
FROM (SELECT DISTINCT * FROM surveys) WHERE survey_type_id IS NOT NULL
UNION ALL SELECT 'sat_well_details', well_id, operator, '1' FROM (SELECT DISTINCT * FROM wells) WHERE well_id IS NOT NULL
UNION ALL SELECT 'sat_well_details', well_id, operator || ' Ltd', '2'
FROM (SELECT DISTINCT * FROM wells) WHERE well_id IS NOT NULL AND well_id % 3 = 0"""))
def q_incremental_masters(spark, sf_dir):
    """All seven tables in three loads: the whole input, one with every third well's operator changed, and that again."""
    vault = INC.IncrementalVault(scratch_dir(spark, "inc-masters"))
    inp = analog.inputs(spark, sf_dir)
    changed = inp["wells"].withColumn("operator", F.when(F.col("well_id") % 3 == 0, F.concat("operator", F.lit(" Ltd"))).otherwise(F.col("operator")))
    for date, wells in (("1", inp["wells"]), ("2", changed), ("3", changed)):
        vault.load(spark, build_vault(inp["surveys"], wells, inp["readings"], date, keep_source_timestamp=True, once=True))
    surveys = vault.table(spark, "sat_survey_details").select(
        F.lit("sat_survey_details").alias("table_name"), F.col("survey_type_id").alias("business_key"),
        F.col("survey_type").alias("attribute"), "load_date")
    wells = (vault.table(spark, "sat_well_details").join(vault.table(spark, "hub_well").select("hub_well_key", "well_id"), "hub_well_key")
             .select(F.lit("sat_well_details").alias("table_name"), F.col("well_id").alias("business_key"),
                     F.col("operator").alias("attribute"), "load_date"))
    return surveys.unionByName(wells)


@register("incremental_rejects", "WITH " + analog.ANALOG_CTES + GAPS_CTE + """
SELECT 'link_survey_well' AS target_table, survey_id, quality_flag, count(*) AS records
FROM (SELECT DISTINCT * FROM gaps WHERE survey_id IS NULL OR well_id IS NULL) GROUP BY survey_id, quality_flag""")
def q_incremental_rejects(spark, sf_dir):
    """Readings whose well id is missing, kept as rejects by the file stream (each distinct record once)."""
    base = scratch_dir(spark, "stream-rejects")
    r = with_gaps(analog.readings(spark, sf_dir))
    r.write.parquet(f"{base}/inbox")
    load_readings_stream(spark, f"{base}/inbox", r.schema, f"{base}/vault", f"{base}/checkpoint", LOAD_TS, max_files_per_trigger=3)
    fields = F.from_json("record", "survey_id bigint, quality_flag bigint")
    return (INC.IncrementalVault(f"{base}/vault").table(spark, "rejects").withColumn("r", fields)
            .groupBy("target_table", F.col("r.survey_id").alias("survey_id"), F.col("r.quality_flag").alias("quality_flag"))
            .agg(F.count(F.lit(1)).alias("records")))


@register("schema_drift", _with(f"""
SELECT survey_id, well_id, depth, amplitude, quality_flag,
       CASE WHEN coalesce(quality_flag, 0) = 0 THEN strftime(ingest_timestamp, {TS_SQL}) END
         AS ingest_timestamp,
       CASE WHEN coalesce(quality_flag, 0) = 1 THEN 'sgx_reconstruction' END AS ingest_source
FROM readings"""))
def q_schema_drift(spark, sf_dir):
    """A second batch arrives without ``ingest_timestamp``, with an extra column and an int flag.

    The drift is reported, the batch aligned to the stored schema (missing
    column NULL, type cast back, new column kept) and appended.
    """
    root = scratch_dir(spark, "drift")
    r = analog.readings(spark, sf_dir)
    flagged = F.coalesce(F.col("quality_flag"), F.lit(0)) == 1
    r.where(~flagged).write.parquet(root)
    stored = spark.read.parquet(root)
    incoming = (r.where(flagged).drop("ingest_timestamp")
                 .withColumn("quality_flag", F.col("quality_flag").cast("int"))
                 .withColumn("ingest_source", F.lit("sgx_reconstruction")))
    INC.align_to(incoming, stored.schema).write.mode("append").parquet(root)
    out = spark.read.option("mergeSchema", "true").parquet(root)
    return out.select("survey_id", "well_id", "depth", "amplitude", "quality_flag",
                      F.date_format("ingest_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                      .alias("ingest_timestamp"), "ingest_source")


@register("schema_drift_report", _with("""
SELECT 'ingest_source' AS column_name, 'added' AS change, CAST(NULL AS VARCHAR) AS stored_type,
       'string' AS incoming_type, CAST(NULL AS BIGINT) AS stored_non_null,
       CAST(count_if(coalesce(quality_flag, 0) = 1) AS BIGINT) AS incoming_non_null
FROM readings
UNION ALL
SELECT 'ingest_timestamp', 'removed', 'timestamp_ntz', NULL,
       count(ingest_timestamp) FILTER (WHERE coalesce(quality_flag, 0) = 0), NULL
FROM readings
UNION ALL
SELECT 'quality_flag', 'type_changed', 'bigint', 'int',
       count(quality_flag) FILTER (WHERE coalesce(quality_flag, 0) = 0),
       count(quality_flag) FILTER (WHERE coalesce(quality_flag, 0) = 1)
FROM readings"""))
def q_schema_drift_report(spark, sf_dir):
    """Drift between the stored batch and an incoming batch, with value counts per column.

    Stored: unflagged readings.  Incoming: flagged readings without
    ``ingest_timestamp``, with an extra ``ingest_source`` and an int flag.
    """
    r = analog.readings(spark, sf_dir)
    flagged = F.coalesce(F.col("quality_flag"), F.lit(0)) == 1
    stored = r.where(~flagged)
    incoming = (r.where(flagged).drop("ingest_timestamp")
                 .withColumn("quality_flag", F.col("quality_flag").cast("int"))
                 .withColumn("ingest_source", F.lit("sgx_reconstruction")))
    return INC.drift_profile(spark, stored, incoming)


@register("stream_drift", _with(f"""
SELECT survey_id, well_id, depth, amplitude, quality_flag,
       CASE WHEN coalesce(quality_flag, 0) = 1 THEN strftime(ingest_timestamp, {TS_SQL}) END AS ingest_timestamp,
       CASE WHEN coalesce(quality_flag, 0) = 1 THEN 'sgx_reconstruction' END AS ingest_source
FROM readings"""))
def q_stream_drift(spark, sf_dir):
    """Reading files in two drops; the second has two more columns, wider flags, and depths as floating numbers."""
    base = scratch_dir(spark, "stream-drift")
    r = analog.readings(spark, sf_dir)
    flagged = F.coalesce(F.col("quality_flag"), F.lit(0)) == 1
    narrow = {"depth": F.col("depth").cast("bigint"), "quality_flag": F.col("quality_flag").cast("int")}
    r.where(~flagged).drop("ingest_timestamp").withColumns(narrow).write.parquet(f"{base}/inbox/first")
    DS.load_drifting(spark, f"{base}/inbox", f"{base}/table", f"{base}/checkpoint")
    r.where(flagged).withColumn("ingest_source", F.lit("sgx_reconstruction")).write.parquet(f"{base}/inbox/second")
    DS.load_drifting(spark, f"{base}/inbox", f"{base}/table", f"{base}/checkpoint")
    out = DS.read(spark, f"{base}/table")
    return out.select("survey_id", "well_id", "depth", "amplitude", "quality_flag", ts_text(F.col("ingest_timestamp")).alias("ingest_timestamp"), "ingest_source")


@register("incremental_stream", _with(f"""
SELECT DISTINCT md5(CAST(survey_id AS VARCHAR) || '_' || CAST(well_id AS VARCHAR)) AS link_survey_well_key,
       depth, amplitude, quality_flag, {SRC_HASH_SQL} AS source_hash
FROM readings WHERE survey_id IS NOT NULL AND well_id IS NOT NULL"""))
def q_incremental_stream(spark, sf_dir):
    """Reading files arrive in two drops; an availableNow stream loads each drop once."""
    base = scratch_dir(spark, "stream")
    inbox, vault_root, ckpt = f"{base}/inbox", f"{base}/vault", f"{base}/checkpoint"
    r = analog.readings(spark, sf_dir)
    early = F.col("ingest_timestamp") < F.lit(STREAM_CUT).cast("timestamp_ntz")
    r.where(early).write.mode("append").parquet(inbox)
    load_readings_stream(spark, inbox, r.schema, vault_root, ckpt, LOAD_TS)
    r.where(~early | F.col("ingest_timestamp").isNull()).write.mode("append").parquet(inbox)
    load_readings_stream(spark, inbox, r.schema, vault_root, ckpt, LOAD_TS)
    sat = INC.IncrementalVault(vault_root).table(spark, "sat_seismic_data")
    return sat.select("link_survey_well_key", "depth", "amplitude", "quality_flag", "source_hash")
