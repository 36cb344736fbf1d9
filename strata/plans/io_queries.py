"""Registered queries: sources and sinks (round trips over the benchmark tables).

Every round trip writes data derived from the benchmark tables into a fresh
folder under the shared checkpoint folder, reads it back through the source
under test, and returns what came back; the oracle is the plain SQL of the
original data, so the round trip itself is what is checked.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators import checks as C
from strata.operators import marts as M
from strata.operators.vault import build_vault
from strata.plans import fixtures as FIX
from strata.plans.flow import run_from_dir
from strata.plans.registry import LOAD_TS, register
from strata.plans.vault_queries import (
    MART_SENSOR_SQL,
    MART_SURVEY_SQL,
    MART_WELL_SQL,
    TS_SQL,
    VAULT_CTES,
    _with,
    input_marts,
    stored_marts,
    vault_tables,
)
from strata.session import scratch_dir
from strata.sinks import files as SF
from strata.sinks import fixedwidth as FWE
from strata.sinks import tables as ST
from strata.sinks import versions as SV
from strata.sources import analog
from strata.sources import files as FS
from strata.sources import jdbc as J
from strata.sources.readings import NoInputError, scan_reconstructed

SURVEY_SCHEMA = "survey_type_id bigint, survey_type string, source_format string"
WELL_SCHEMA = ("well_id bigint, well_name string, location_lat double, location_long double, "
               "operator string")


@register("scan_csv", _with("SELECT survey_type_id, survey_type, source_format FROM surveys"))
def q_scan_csv(spark, sf_dir):
    """Survey master written as CSV with a header, read back with a declared schema."""
    out = scratch_dir(spark, "csv")
    analog.survey_master(spark, sf_dir).write.mode("overwrite").option("header", True).csv(out)
    return FS.read_csv(spark, out, SURVEY_SCHEMA)


@register("scan_csv_reordered", _with("SELECT well_id, well_name, location_lat, location_long, operator FROM wells"))
def q_scan_csv_reordered(spark, sf_dir):
    """Well master whose file has other columns first and one more; columns are bound by the header's names."""
    out = scratch_dir(spark, "csv-reordered")
    wells = analog.well_master(spark, sf_dir)
    (wells.select(F.lit("x").alias("comment"), "operator", "well_name", "location_long", "location_lat", "well_id")
     .write.option("header", True).csv(out))
    return FS.read_csv(spark, out, WELL_SCHEMA).drop("comment")


@register("scan_mixed_width", _with("""
SELECT survey_id, well_id, CASE WHEN quality_flag = 1 THEN CAST(CAST(depth AS FLOAT) AS DOUBLE) ELSE depth END AS depth,
       CASE WHEN quality_flag = 1 THEN CAST(CAST(amplitude AS FLOAT) AS DOUBLE) ELSE amplitude END AS amplitude, quality_flag
FROM readings"""))
def q_scan_mixed_width(spark, sf_dir):
    """Files that store ids and values in 32 bits beside files that store them in 64."""
    out = scratch_dir(spark, "widths")
    r = analog.readings(spark, sf_dir).drop("ingest_timestamp")
    flagged = F.coalesce(F.col("quality_flag"), F.lit(0)) == 1
    narrow = r.where(flagged).select(*[F.col(c).cast("int").alias(c) for c in ("survey_id", "well_id", "quality_flag")],
                                     *[F.col(c).cast("float").alias(c) for c in ("depth", "amplitude")])
    SF.stored(SF.write_parquet_groups(narrow, out + "/narrow"))
    SF.stored(SF.write_parquet_groups(r.where(~flagged), out + "/wide"))
    return scan_reconstructed(spark, out).select("survey_id", "well_id", "depth", "amplitude", "quality_flag")


@register("scan_glob_union", _with(f"""
SELECT survey_id, well_id, depth, amplitude, quality_flag,
       CASE WHEN coalesce(quality_flag, 0) = 0 THEN 'sgx_reconstruction' END AS ingest_source,
       CASE WHEN coalesce(quality_flag, 0) = 0 THEN strftime(ingest_timestamp, {TS_SQL}) END
         AS ingest_timestamp
FROM readings"""))
def q_scan_glob_union(spark, sf_dir):
    """Readings spread over nested ``*_reconstructed.parquet`` files whose columns differ.

    Files of flagged readings lack ``ingest_timestamp``; files of the others
    carry an extra ``ingest_source``.  One recursive, glob-filtered scan with
    schema merging unions them by name (missing columns read as NULL).
    """
    out = scratch_dir(spark, "glob")
    r = analog.readings(spark, sf_dir)
    staged = (r.withColumn("ingest_source", F.lit("sgx_reconstruction"))
               .withColumn("grp", F.when(F.coalesce("quality_flag", F.lit(0)) == 0, "plain")
                           .otherwise("flagged")))
    SF.stored(SF.write_parquet_groups(
        staged, out, group_col="grp",
        drop_cols_when={"flagged": ["ingest_timestamp", "ingest_source"]}))
    # Decoys the glob must skip: an upper-case suffix and a plain Parquet name.
    region = analog.table(spark, sf_dir, "region")
    SF.stored(SF.write_parquet_groups(region, out + "/decoy", suffix="_RECONSTRUCTED.PARQUET"))
    SF.stored(SF.write_parquet_groups(region, out + "/decoy", suffix=".parquet"))
    df = scan_reconstructed(spark, out)
    return df.select("survey_id", "well_id", "depth", "amplitude", "quality_flag", "ingest_source",
                     M.ts_text(F.col("ingest_timestamp")).alias("ingest_timestamp"))


@register("scan_optional_missing", _with("""
SELECT 'hub_survey' AS table_name, count(*) AS row_count FROM hub_survey
UNION ALL SELECT 'sat_survey_details', count(*) FROM surveys WHERE survey_type_id IS NOT NULL
UNION ALL SELECT 'hub_well', 0
UNION ALL SELECT 'sat_well_details', 0
UNION ALL SELECT 'readings_found', 0"""))
def q_scan_optional_missing(spark, sf_dir):
    """Present survey CSV, absent well CSV, no reading files: hubs still load."""
    base = scratch_dir(spark, "optional")
    analog.survey_master(spark, sf_dir).write.option("header", True).csv(f"{base}/master_surveys.csv")
    surveys = FS.read_csv_optional(spark, f"{base}/master_surveys.csv", SURVEY_SCHEMA)
    wells = FS.read_csv_optional(spark, f"{base}/master_wells.csv", WELL_SCHEMA)
    try:
        readings = scan_reconstructed(spark, f"{base}/readings")
        found = 1
    except NoInputError:
        readings, found = None, 0
    vault = build_vault(surveys, wells, readings, LOAD_TS)
    counts = C.table_counts({k: vault[k] for k in ("hub_survey", "sat_survey_details",
                                                   "hub_well", "sat_well_details")})
    return counts.unionByName(spark.range(1).select(F.lit("readings_found").alias("table_name"),
                                                    F.lit(found).cast("bigint").alias("row_count")))


def _derby(spark) -> J.JdbcSettings:
    return J.JdbcSettings.from_conf(spark)


@register("jdbc_roundtrip", _with(f"""
SELECT hub_well_key, well_id, '{LOAD_TS}' AS load_date FROM hub_well"""))
def q_jdbc_roundtrip(spark, sf_dir):
    """hub_well replaced in a JDBC database, read back by parallel range queries."""
    settings = J.probe(spark, _derby(spark))
    if settings is None:
        raise RuntimeError("JDBC database not reachable")
    table = f"hub_well_{uuid.uuid4().hex[:8]}"
    J.write_table(vault_tables(spark, sf_dir)["hub_well"], settings, table)
    back = J.read_table(spark, settings, table, partition_column="well_id", num_partitions=4)
    back = J.lowercase_columns(back)
    return back.select("hub_well_key", F.col("well_id").cast("bigint").alias("well_id"), "load_date")


@register("jdbc_replace", _with("SELECT hub_well_key, well_id FROM hub_well"))
def q_jdbc_replace(spark, sf_dir):
    """hub_well loaded, then a load of it that fails on its way: the table keeps the first load's rows."""
    settings = _derby(spark)
    table = f"hub_well_{uuid.uuid4().hex[:8]}"
    hub = vault_tables(spark, sf_dir, only=("wells",))["hub_well"].select("hub_well_key", "well_id")
    J.replace_table(hub, settings, table)
    stop = F.when(F.col("well_id") % 5 == 0, F.raise_error(F.lit("source lost"))).otherwise(F.col("well_id")).cast("bigint")
    try:
        J.replace_table(hub.withColumn("well_id", stop), settings, table)
    except Exception as exc:
        if "source lost" not in str(exc):
            raise
    back = J.lowercase_columns(J.read_table(spark, settings, table))
    return back.select("hub_well_key", F.col("well_id").cast("bigint").alias("well_id"))


@register("jdbc_balanced", _with("""
SELECT CASE WHEN well_id % 3 = 0 THEN 7 ELSE well_id * well_id END AS skewed, survey_id, well_id, quality_flag
FROM readings"""))
def q_jdbc_balanced(spark, sf_dir):
    """Readings by a skewed key (a third on one value, the rest far apart), read back in ranges of equal row counts."""
    settings = _derby(spark)
    table = f"readings_{uuid.uuid4().hex[:8]}"
    skewed = F.when(F.col("well_id") % 3 == 0, 7).otherwise(F.col("well_id") * F.col("well_id")).cast("bigint")
    J.replace_table(analog.readings(spark, sf_dir).select(skewed.alias("skewed"), "survey_id", "well_id", "quality_flag"), settings, table)
    back = J.read_balanced(spark, settings, table, "skewed", 8, tie="survey_id")
    return back.select(*[F.col(c).cast("bigint").alias(c) for c in ("skewed", "survey_id", "well_id", "quality_flag")])


@register("parquet_sink", _with(f"""
SELECT link_survey_well_key, hub_survey_key, hub_well_key, '{LOAD_TS}' AS load_date,
       'sgx_reconstruction' AS record_source FROM link"""))
def q_parquet_sink(spark, sf_dir):
    out = scratch_dir(spark, "vault")
    v = vault_tables(spark, sf_dir)
    ST.write_parquet(v["link_survey_well"], f"{out}/link_survey_well")
    return spark.read.parquet(f"{out}/link_survey_well")


@register("dual_sink", _with("""
SELECT 'hub_survey' AS table_name, 'parquet' AS sink, 'ok' AS status, count(*) AS row_count FROM hub_survey
UNION ALL SELECT 'hub_survey', 'jdbc', 'ok', count(*) FROM hub_survey
UNION ALL SELECT 'hub_survey', 'jdbc_readback', 'ok', count(*) FROM hub_survey"""))
def q_dual_sink(spark, sf_dir):
    """File always, database best effort; the database copy is loaded from the file."""
    out = scratch_dir(spark, "dual")
    settings = J.probe(spark, _derby(spark))
    name = f"hub_survey_{uuid.uuid4().hex[:8]}"
    rep = ST.write_table(spark, vault_tables(spark, sf_dir)["hub_survey"], name, out, settings)
    back = J.lowercase_columns(J.run_query(spark, settings, f"select count(*) as row_count from {name}"))
    back = back.select(F.col("row_count").cast("bigint"))
    back = back.select(F.lit("jdbc_readback").alias("sink"), F.lit("ok").alias("status"), "row_count")
    rep = rep.select("sink", "status", "row_count").unionByName(back)
    return rep.select(F.lit("hub_survey").alias("table_name"), "sink", "status", "row_count")


@register("load_audit", _with(f"""
SELECT 'hub_survey' AS table_name, 'parquet' AS sink, 'ok' AS status, count(*) AS row_count,
       '{LOAD_TS}' AS load_date FROM hub_survey
UNION ALL SELECT 'sat_survey_details', 'parquet', 'ok', count(*), '{LOAD_TS}' FROM surveys
  WHERE survey_type_id IS NOT NULL
UNION ALL SELECT 'hub_well', 'parquet', 'ok', count(*), '{LOAD_TS}' FROM hub_well
UNION ALL SELECT 'sat_well_details', 'parquet', 'ok', count(*), '{LOAD_TS}' FROM wells WHERE well_id IS NOT NULL
UNION ALL SELECT 'link_survey_well', 'parquet', 'ok', count(*), '{LOAD_TS}' FROM link
UNION ALL SELECT 'sat_seismic_data', 'parquet', 'ok', count(*), '{LOAD_TS}' FROM sat"""))
def q_load_audit(spark, sf_dir):
    """Row counts of every vault table, counted while it is written."""
    out = scratch_dir(spark, "audit")
    v = vault_tables(spark, sf_dir)
    v.pop("rejects")
    return ST.load_audit(spark, ST.write_tables(spark, v, out), LOAD_TS)


def _publish_sensor_versions(spark, sf_dir):
    root = scratch_dir(spark, "versions") + "/mart_sensor_analysis"
    mart = input_marts(spark, sf_dir)["mart_sensor_analysis"]
    SV.publish(spark, mart, root)                      # v0
    SV.publish(spark, mart, root)                      # v1, same content (idempotent re-run)
    try:
        SV.publish(spark, mart.where(F.lit(False)), root)          # refused: empty replace
    except SV.EmptyPublishError:
        pass
    SV.publish(spark, mart.where(F.lit(False)), root, allow_empty=True)   # v2, forced empty
    return root


@register("version_overwrite", _with(f"""
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, 'Overwrite' AS mode, count(*) AS num_added_rows
FROM ({MART_SENSOR_SQL})
UNION ALL SELECT 1, 'WRITE', 'Overwrite', count(*) FROM ({MART_SENSOR_SQL})
UNION ALL SELECT 2, 'WRITE', 'Overwrite', 0"""))
def q_version_overwrite(spark, sf_dir):
    root = _publish_sensor_versions(spark, sf_dir)
    return SV.history(spark, root).select("version", "operation", "mode", "num_added_rows")


@register("version_as_of", _with(f"""
SELECT 0 AS version, * FROM ({MART_SENSOR_SQL})
UNION ALL SELECT 1 AS version, * FROM ({MART_SENSOR_SQL})"""))
def q_version_as_of(spark, sf_dir):
    root = _publish_sensor_versions(spark, sf_dir)
    parts = [SV.read_as_of(spark, root, v).select(F.lit(v).alias("version"), "*") for v in (0, 1, 2)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("catalog_marts", _with(f"""
SELECT 'mart_sensor_analysis' AS table_name, count(*) AS row_count FROM ({MART_SENSOR_SQL})
UNION ALL SELECT 'mart_survey_summary', count(*) FROM ({MART_SURVEY_SQL})
UNION ALL SELECT 'mart_well_performance', count(*) FROM ({MART_WELL_SQL})"""))
def q_catalog_marts(spark, sf_dir):
    """Marts saved as catalog tables for SQL tools and found again by name pattern."""
    ST.save_tables(stored_marts(spark, sf_dir), scratch_dir(spark, "catalog"))
    names = ST.list_tables(spark, "mart_*")
    return C.table_counts({n: spark.table(n) for n in names if n in M.MART_NAMES})


E2E_CTES = VAULT_CTES.replace("readings AS (", "raw_readings AS (", 1).replace("surveys AS (", """readings AS (
  SELECT survey_id, well_id, CASE WHEN quality_flag = 1 THEN CAST(CAST(depth AS FLOAT) AS DOUBLE) ELSE depth END AS depth,
         CASE WHEN quality_flag = 1 THEN CAST(CAST(amplitude AS FLOAT) AS DOUBLE) ELSE amplitude END AS amplitude,
         quality_flag, ingest_timestamp FROM raw_readings),
surveys AS (""", 1)


@register("pipeline_end_to_end", "WITH " + E2E_CTES + f"""
SELECT 'rows of hub_survey' AS item, count(*) AS n, CAST(NULL AS DOUBLE) AS avg_amplitude FROM hub_survey
UNION ALL SELECT 'rows of hub_well', count(*), NULL FROM hub_well
UNION ALL SELECT 'rows of sat_survey_details', count(*), NULL FROM surveys WHERE survey_type_id IS NOT NULL
UNION ALL SELECT 'rows of sat_well_details', count(*), NULL FROM wells WHERE well_id IS NOT NULL
UNION ALL SELECT 'rows of link_survey_well', count(*), NULL FROM link
UNION ALL SELECT 'rows of sat_seismic_data', count(*), NULL FROM sat
UNION ALL SELECT 'rows of rejects', 0, NULL
UNION ALL SELECT 'check ' || check_name, bad_rows, NULL FROM (
  SELECT 'unique:hub_survey.hub_survey_key' AS check_name, 0 AS bad_rows
  UNION ALL SELECT 'references:link_survey_well.hub_well_key->hub_well.hub_well_key', 0
  UNION ALL SELECT 'at_least:sat_seismic_data.depth>=0', 0)
UNION ALL SELECT 'type ' || survey_type, total_readings, avg_amplitude FROM ({MART_SENSOR_SQL})""")
def q_pipeline_end_to_end(spark, sf_dir):
    """From a data folder to marts: CSV masters by name, trace files decoded, damaged Parquet salvaged, the rest scanned."""
    base = scratch_dir(spark, "end-to-end")
    inp = analog.inputs(spark, sf_dir)
    inp["surveys"].select("source_format", "survey_type", "survey_type_id").write.option("header", True).csv(f"{base}/in/master_surveys.csv")
    inp["wells"].select("operator", "well_name", "well_id").write.option("header", True).csv(f"{base}/in/master_wells.csv")
    r = inp["readings"]
    flagged, deep = F.coalesce(F.col("quality_flag"), F.lit(0)) == 1, F.coalesce(F.col("depth"), F.lit(0)) > 25
    FWE.written(FWE.encode(FWE.readings_frame(r.where(flagged)), f"{base}/traces"))
    SF.stored(SF.write_parquet_groups(r.where(~flagged & ~deep), f"{base}/in/deep"))
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("healthy", "trailing_junk", "junk_with_par1", "wrong_footer_len")]),
                         (F.pmod(F.col("survey_id"), F.lit(4)) + 1).cast("int"))
    whole = SF.stored(SF.write_parquet_groups(r.where(~flagged & deep).withColumn("kind", kinds), f"{base}/whole", group_col="kind", suffix=".parquet"))
    SF.stored(FIX.damage_files(whole, f"{base}/damaged", f"{base}/whole"))
    res = run_from_dir(spark, f"{base}/in", f"{base}/out", LOAD_TS, traces_dir=f"{base}/traces", damaged_dir=f"{base}/damaged")
    none = F.lit(None).cast("double").alias("avg_amplitude")
    vault = res["report"].where("sink = 'parquet' and table_name not like 'mart%'")
    return (vault.select(F.concat(F.lit("rows of "), "table_name").alias("item"), F.col("row_count").alias("n"), none)
            .unionByName(res["checks"].select(F.concat(F.lit("check "), "check_name").alias("item"), F.col("bad_rows").alias("n"), none))
            .unionByName(res["mart_sensor_analysis"].select(F.concat(F.lit("type "), "survey_type").alias("item"), F.col("total_readings").alias("n"),
                                                            M.round_sig("avg_amplitude").alias("avg_amplitude"))))
