"""Registered queries: keys, vault tables, marts and data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import md5_key, sha256_key, with_change_hash
from strata.operators import checks as C
from strata.operators import marts as M
from strata.operators.vault import SOURCE_FORMAT_CANDIDATES, build_vault, survey_sat
from strata.plans.registry import LOAD_TS, register
from strata.session import scratch_dir
from strata.sources import analog

TS_SQL = "'%Y-%m-%dT%H:%M:%S.%f'"


def vault_tables(spark: SparkSession, sf_dir: str, keep_source_timestamp: bool = True,
                 key_hash: str = "md5", only: tuple[str, ...] = ("surveys", "wells", "readings")
                 ) -> dict[str, DataFrame]:
    """The vault over the benchmark tables; ``only`` limits which inputs are read."""
    surveys = analog.survey_master(spark, sf_dir) if "surveys" in only else None
    wells = analog.well_master(spark, sf_dir) if "wells" in only else None
    readings = analog.readings(spark, sf_dir) if "readings" in only else None
    return build_vault(surveys, wells, readings, LOAD_TS, key_hash,
                       keep_source_timestamp=keep_source_timestamp)


# ---- SQL building blocks (DuckDB) -------------------------------------------------

VAULT_CTES = analog.ANALOG_CTES + """,
hub_survey AS (
  SELECT DISTINCT md5(CAST(survey_type_id AS VARCHAR)) AS hub_survey_key, survey_type_id
  FROM surveys WHERE survey_type_id IS NOT NULL),
hub_well AS (
  SELECT DISTINCT md5(CAST(well_id AS VARCHAR)) AS hub_well_key, well_id
  FROM wells WHERE well_id IS NOT NULL),
survey_sat AS (
  SELECT DISTINCT survey_type_id, survey_type, source_format
  FROM surveys WHERE survey_type_id IS NOT NULL),
link AS (
  SELECT DISTINCT md5(CAST(survey_id AS VARCHAR) || '_' || CAST(well_id AS VARCHAR)) AS link_survey_well_key,
         md5(CAST(survey_id AS VARCHAR)) AS hub_survey_key, md5(CAST(well_id AS VARCHAR)) AS hub_well_key
  FROM readings WHERE survey_id IS NOT NULL AND well_id IS NOT NULL),
sat AS (
  SELECT md5(CAST(survey_id AS VARCHAR) || '_' || CAST(well_id AS VARCHAR)) AS link_survey_well_key,
         depth, amplitude, quality_flag, ingest_timestamp
  FROM readings WHERE survey_id IS NOT NULL AND well_id IS NOT NULL),
core AS (
  SELECT * FROM sat JOIN link USING (link_survey_well_key)
                    JOIN hub_well USING (hub_well_key)
                    JOIN hub_survey USING (hub_survey_key)
                    LEFT JOIN survey_sat USING (survey_type_id))
"""


def _with(body: str) -> str:
    return "WITH " + VAULT_CTES + body


def number_sql(c: str) -> str:
    """The exact text of a double (``number_text``) in SQL, for sizes from 2^-900 on."""
    guess = f"floor(log2(abs({c})))"
    e = f"({guess} + CASE WHEN pow(2.0, {guess}) > abs({c}) THEN -1 WHEN pow(2.0, {guess} + 1) <= abs({c}) THEN 1 ELSE 0 END)"
    sign = f"CASE WHEN {c} < 0 THEN '-' ELSE '' END"
    return (f"CASE WHEN {c} IS NULL THEN 'null' WHEN isnan({c}) THEN 'nan' WHEN isinf({c}) THEN {sign} || 'inf' WHEN {c} = 0 THEN '0' "
            f"ELSE {sign} || CAST(CAST(abs({c}) * pow(2.0, 52 - {e}) AS BIGINT) AS VARCHAR) || 'p' || CAST(CAST({e} - 52 AS BIGINT) AS VARCHAR) END")


def sig_sql(x: str, bits: int = 34) -> str:
    """``round_sig`` in SQL."""
    p = f"pow(2.0, {bits - 1} - floor(log2(abs({x}))))"
    return f"CASE WHEN {x} IS NULL OR isnan({x}) OR isinf({x}) OR {x} = 0 THEN {x} ELSE floor({x} * {p} + 0.5) / {p} END"


SRC_HASH_SQL = (f"md5({number_sql('depth')} || '_' || {number_sql('amplitude')} || '_' || "
                "coalesce(CAST(quality_flag AS VARCHAR), 'null'))")
# favg adds without loss, but not infinities.
AVG_SQL = sig_sql("(CASE WHEN bool_or(isinf(amplitude)) THEN avg(amplitude) ELSE favg(amplitude) END)") + " AS avg_amplitude"

MART_WELL_SQL = f"""
SELECT well_id, source_format, count(depth) AS total_readings, {AVG_SQL},
       CAST(count_if(quality_flag = 1) AS DOUBLE) / count(depth) AS data_quality_rate
FROM core WHERE well_id IS NOT NULL AND source_format IS NOT NULL
GROUP BY well_id, source_format"""

MART_SENSOR_SQL = f"""
SELECT survey_type, count(depth) AS total_readings, {AVG_SQL},
       CAST(count_if(quality_flag = 1) AS DOUBLE) / count(depth) AS data_quality_rate
FROM core WHERE survey_type IS NOT NULL
GROUP BY survey_type"""

WELLS_SURVEYED_SQL = """
SELECT survey_type_id, count(DISTINCT hub_well_key) AS wells_surveyed_count
FROM (SELECT DISTINCT hub_survey_key, hub_well_key FROM link) l JOIN hub_survey USING (hub_survey_key)
WHERE survey_type_id IS NOT NULL
GROUP BY survey_type_id"""

MART_SURVEY_SQL = f"""
SELECT survey_type, source_format, wells_surveyed_count, total_readings, avg_amplitude,
       strftime(earliest_ts, {TS_SQL}) AS earliest_timestamp,
       strftime(latest_ts, {TS_SQL}) AS latest_timestamp
FROM (SELECT survey_type, source_format, survey_type_id, count(depth) AS total_readings, {AVG_SQL},
             min(ingest_timestamp) AS earliest_ts, max(ingest_timestamp) AS latest_ts
      FROM core
      WHERE survey_type IS NOT NULL AND source_format IS NOT NULL AND survey_type_id IS NOT NULL
      GROUP BY survey_type, source_format, survey_type_id) m
LEFT JOIN ({WELLS_SURVEYED_SQL}) w USING (survey_type_id)"""


def shown(mart: DataFrame) -> DataFrame:
    """A mart with its mean rounded as the oracles round theirs."""
    return mart.withColumn("avg_amplitude", M.round_sig("avg_amplitude"))


def input_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    inp = analog.inputs(spark, sf_dir)
    return {k: shown(v) for k, v in M.marts_from_facts(M.facts_from_inputs(**inp)).items()}


def input_well_mart(inputs: dict[str, DataFrame]) -> DataFrame:
    return shown(M.well_performance_from_inputs(**inputs))


def stored_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three marts on per-link facts that are computed once and written to the shared folder."""
    facts = M.facts_from_inputs(**analog.inputs(spark, sf_dir))
    path = scratch_dir(spark, "facts")
    facts.write.parquet(path)
    return {k: shown(v) for k, v in M.marts_from_facts(spark.read.schema(facts.schema).parquet(path)).items()}


# ---- keys ----------------------------------------------------------------------

@register("hash_keys", _with("""
SELECT survey_id, well_id, md5(CAST(survey_id AS VARCHAR)) AS hub_survey_key,
       md5(CAST(well_id AS VARCHAR)) AS hub_well_key
FROM readings"""))
def q_hash_keys(spark, sf_dir):
    r = analog.readings(spark, sf_dir)
    return r.select("survey_id", "well_id", md5_key("survey_id").alias("hub_survey_key"),
                    md5_key("well_id").alias("hub_well_key"))


@register("hash_keys_sha256", _with("""
SELECT well_id, well_name, sha256(upper(trim(CAST(well_id AS VARCHAR)))) AS hub_well_key,
       sha256(upper(trim(well_name))) AS well_name_key,
       sha256(upper(trim(operator))) AS operator_key
FROM wells"""))
def q_hash_keys_sha256(spark, sf_dir):
    w = analog.well_master(spark, sf_dir)
    return w.select("well_id", "well_name", sha256_key("well_id").alias("hub_well_key"),
                    sha256_key("well_name").alias("well_name_key"),
                    sha256_key("operator").alias("operator_key"))


@register("link_keys", _with("""
SELECT survey_id, well_id,
       md5(CAST(survey_id AS VARCHAR) || '_' || CAST(well_id AS VARCHAR)) AS link_survey_well_key
FROM readings"""))
def q_link_keys(spark, sf_dir):
    r = analog.readings(spark, sf_dir)
    return r.select("survey_id", "well_id",
                    md5_key("survey_id", "well_id").alias("link_survey_well_key"))


@register("source_hash", _with(f"""
SELECT survey_id, well_id, depth, amplitude, quality_flag, {SRC_HASH_SQL} AS source_hash
FROM readings"""))
def q_source_hash(spark, sf_dir):
    r = analog.readings(spark, sf_dir)
    return with_change_hash(r.select("survey_id", "well_id", "depth", "amplitude", "quality_flag"),
                            ["depth", "amplitude", "quality_flag"], "source_hash")


# ---- vault tables ----------------------------------------------------------------

@register("hub_survey", _with(f"""
SELECT hub_survey_key, survey_type_id, '{LOAD_TS}' AS load_date, 'master_surveys.csv' AS record_source
FROM hub_survey"""))
def q_hub_survey(spark, sf_dir):
    return vault_tables(spark, sf_dir, only=("surveys",))["hub_survey"]


@register("hub_well", _with(f"""
SELECT hub_well_key, well_id, '{LOAD_TS}' AS load_date, 'master_wells.csv' AS record_source
FROM hub_well"""))
def q_hub_well(spark, sf_dir):
    return vault_tables(spark, sf_dir, only=("wells",))["hub_well"]


@register("sat_survey_details", _with(f"""
SELECT md5(CAST(survey_type_id AS VARCHAR)) AS hub_survey_key, survey_type, survey_type_id,
       source_format, '{LOAD_TS}' AS load_date
FROM surveys WHERE survey_type_id IS NOT NULL"""))
def q_sat_survey_details(spark, sf_dir):
    return vault_tables(spark, sf_dir, only=("surveys",))["sat_survey_details"]


@register("sat_well_details", _with(f"""
SELECT md5(CAST(well_id AS VARCHAR)) AS hub_well_key, well_name, operator, location_lat,
       location_long, '{LOAD_TS}' AS load_date
FROM wells WHERE well_id IS NOT NULL"""))
def q_sat_well_details(spark, sf_dir):
    return vault_tables(spark, sf_dir, only=("wells",))["sat_well_details"]


@register("link_survey_well", _with(f"""
SELECT link_survey_well_key, hub_survey_key, hub_well_key, '{LOAD_TS}' AS load_date,
       'sgx_reconstruction' AS record_source
FROM link"""))
def q_link_survey_well(spark, sf_dir):
    return vault_tables(spark, sf_dir, only=("readings",))["link_survey_well"]


@register("sat_seismic", _with(f"""
SELECT md5(CAST(survey_id AS VARCHAR) || '_' || CAST(well_id AS VARCHAR)) AS link_survey_well_key,
       depth, amplitude, quality_flag, 'sgx_reconstruction' AS ingest_source,
       {SRC_HASH_SQL} AS source_hash,
       strftime(ingest_timestamp, {TS_SQL}) AS ingest_timestamp, '{LOAD_TS}' AS load_date
FROM readings WHERE survey_id IS NOT NULL AND well_id IS NOT NULL"""))
def q_sat_seismic(spark, sf_dir):
    sat = vault_tables(spark, sf_dir, only=("readings",))["sat_seismic_data"]
    return sat.withColumn("ingest_timestamp", M.ts_text(F.col("ingest_timestamp")))


@register("vault_counts", _with("""
SELECT 'hub_survey' AS table_name, count(*) AS row_count FROM hub_survey
UNION ALL SELECT 'sat_survey_details', count(*) FROM surveys WHERE survey_type_id IS NOT NULL
UNION ALL SELECT 'hub_well', count(*) FROM hub_well
UNION ALL SELECT 'sat_well_details', count(*) FROM wells WHERE well_id IS NOT NULL
UNION ALL SELECT 'link_survey_well', count(*) FROM link
UNION ALL SELECT 'sat_seismic_data', count(*) FROM sat
UNION ALL SELECT 'rejects', (SELECT count(*) FROM surveys WHERE survey_type_id IS NULL)
                          + (SELECT count(*) FROM wells WHERE well_id IS NULL)
                          + (SELECT count(*) FROM readings WHERE survey_id IS NULL OR well_id IS NULL)"""))
def q_vault_counts(spark, sf_dir):
    return C.table_counts(vault_tables(spark, sf_dir))


@register("first_available_column", _with("""
SELECT shape, source_format, count(*) AS n_rows
FROM (SELECT 'source_format' AS shape, source_format FROM surveys WHERE survey_type_id IS NOT NULL
      UNION ALL SELECT 'file_format', source_format FROM surveys WHERE survey_type_id IS NOT NULL
      UNION ALL SELECT 'format', source_format FROM surveys WHERE survey_type_id IS NOT NULL
      UNION ALL SELECT 'none', 'csv' FROM surveys WHERE survey_type_id IS NOT NULL)
GROUP BY shape, source_format"""))
def q_first_available_column(spark, sf_dir):
    """The satellite's source format from whichever format column the master has."""
    s = analog.survey_master(spark, sf_dir)
    shapes = {"source_format": s}
    for name in SOURCE_FORMAT_CANDIDATES[1:]:
        shapes[name] = s.withColumnRenamed("source_format", name)
    shapes["none"] = s.drop("source_format")
    parts = [survey_sat(df, LOAD_TS).select(F.lit(shape).alias("shape"), "source_format")
             for shape, df in shapes.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("shape", "source_format").agg(F.count(F.lit(1)).alias("n_rows"))


# ---- marts ---------------------------------------------------------------------

@register("core_join", _with(f"""
SELECT well_id, survey_type_id, survey_type, source_format, depth, amplitude, quality_flag,
       strftime(ingest_timestamp, {TS_SQL}) AS ingest_timestamp
FROM core"""))
def q_core_join(spark, sf_dir):
    core = M.core_join(vault_tables(spark, sf_dir))
    return core.select("well_id", "survey_type_id", "survey_type", "source_format", "depth",
                       "amplitude", "quality_flag",
                       M.ts_text(F.col("ingest_timestamp")).alias("ingest_timestamp"))


@register("core_join_salted", _with(f"""
SELECT well_id, survey_type_id, survey_type, source_format, depth, amplitude, quality_flag,
       strftime(ingest_timestamp, {TS_SQL}) AS ingest_timestamp
FROM core"""))
def q_core_join_salted(spark, sf_dir):
    """The reading-level join with each hot link spread over 8 salts."""
    core = M.core_join(vault_tables(spark, sf_dir), salts=8)
    return core.select("well_id", "survey_type_id", "survey_type", "source_format", "depth",
                       "amplitude", "quality_flag",
                       M.ts_text(F.col("ingest_timestamp")).alias("ingest_timestamp"))


@register("wells_surveyed", _with(WELLS_SURVEYED_SQL))
def q_wells_surveyed(spark, sf_dir):
    return M.wells_surveyed(vault_tables(spark, sf_dir))


@register("mart_well_performance", _with(MART_WELL_SQL))
def q_mart_well_performance(spark, sf_dir):
    return input_well_mart(analog.inputs(spark, sf_dir))


@register("mart_sensor_analysis", _with(MART_SENSOR_SQL))
def q_mart_sensor_analysis(spark, sf_dir):
    return input_marts(spark, sf_dir)["mart_sensor_analysis"]


@register("mart_survey_summary", _with(MART_SURVEY_SQL))
def q_mart_survey_summary(spark, sf_dir):
    return input_marts(spark, sf_dir)["mart_survey_summary"]


@register("mart_sensor_analysis_direct", _with(MART_SENSOR_SQL))
def q_mart_sensor_analysis_direct(spark, sf_dir):
    """The same mart from reading-level rows (no per-link pre-aggregate)."""
    return shown(M.build_marts(vault_tables(spark, sf_dir), preaggregate=False)["mart_sensor_analysis"])


@register("mart_well_performance_direct", _with(MART_WELL_SQL))
def q_mart_well_performance_direct(spark, sf_dir):
    return shown(M.build_marts(vault_tables(spark, sf_dir), preaggregate=False)["mart_well_performance"])


@register("mart_preview", _with(MART_WELL_SQL + "\nORDER BY well_id, source_format LIMIT 20"))
def q_mart_preview(spark, sf_dir):
    mart = input_well_mart(analog.inputs(spark, sf_dir))
    return M.mart_preview(mart, ["well_id", "source_format"], 20)


@register("mart_preaggregated", _with(f"""
SELECT link_survey_well_key, well_id, survey_type_id, survey_type, source_format,
       count(depth) AS n_depth, count(amplitude) AS n_amp,
       {sig_sql('fsum(amplitude)')} AS amp_sum,
       CAST(count_if(quality_flag = 1) AS BIGINT) AS n_flags,
       strftime(min(ingest_timestamp), {TS_SQL}) AS min_ts,
       strftime(max(ingest_timestamp), {TS_SQL}) AS max_ts
FROM core
GROUP BY link_survey_well_key, well_id, survey_type_id, survey_type, source_format"""))
def q_mart_preaggregated(spark, sf_dir):
    """The shared per-link partials the three marts roll up."""
    f = M.facts_from_inputs(**analog.inputs(spark, sf_dir)).where("in_hub")
    return f.select(md5_key("survey_type_id", "well_id").alias("link_survey_well_key"), "well_id", "survey_type_id",
                    "survey_type", "source_format", "n_depth", "n_amp", M.round_sig("amp_sum").alias("amp_sum"), "n_flags",
                    M.ts_text(F.col("min_ts")).alias("min_ts"),
                    M.ts_text(F.col("max_ts")).alias("max_ts"))


# ---- checks --------------------------------------------------------------------

def _check_sql(name: str, detail: str, bad: str, total: str, source: str) -> str:
    return (f"SELECT '{name}' AS check_name, CASE WHEN {bad} = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"{bad} AS bad_rows, {total} AS total_rows, '{detail}' AS detail FROM {source}")


def _unique_sql(table: str, key: str, source: str) -> str:
    return _check_sql(f"unique:{table}.{key}", f"{table}.{key} has no repeated value",
                      f"(count({key}) - count(DISTINCT {key}))", f"count({key})", source)


def _refs_sql(child: str, key: str, parent: str, child_src: str, parent_src: str) -> str:
    bad = f"CAST(count_if({key} IS NOT NULL AND matched IS NULL) AS BIGINT)"
    src = (f"(SELECT c.{key}, p.matched FROM (SELECT {key} FROM {child_src}) c LEFT JOIN "
           f"(SELECT DISTINCT {key}, true AS matched FROM {parent_src}) p USING ({key}))")
    return _check_sql(f"references:{child}.{key}->{parent}.{key}", f"every {child}.{key} exists in {parent}",
                      bad, f"count({key})", src)


def _range_sql(table: str, col: str, minimum: int, source: str) -> str:
    return _check_sql(f"at_least:{table}.{col}>={minimum}", f"{table}.{col} is not below {minimum}",
                      f"CAST(count_if({col} < {minimum}) AS BIGINT)", "count(*)", source)


@register("dq_unique", _with(
    _unique_sql("hub_survey", "hub_survey_key", "hub_survey") + "\nUNION ALL\n"
    + _unique_sql("hub_well", "hub_well_key", "hub_well") + "\nUNION ALL\n"
    + _unique_sql("sat_seismic_data", "source_hash",
                  f"(SELECT {SRC_HASH_SQL} AS source_hash FROM readings "
                  "WHERE survey_id IS NOT NULL AND well_id IS NOT NULL)")))
def q_dq_unique(spark, sf_dir):
    v = vault_tables(spark, sf_dir)
    checks = [C.unique_key("hub_survey", "hub_survey_key"), C.unique_key("hub_well", "hub_well_key"),
              C.unique_key("sat_seismic_data", "source_hash")]
    return C.run_checks(spark, v, checks)


EVEN_HUB = "(SELECT * FROM hub_well WHERE well_id % 2 = 0)"


def damaged_vault(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The vault with every odd well missing from its hub, so that the checks have something to find."""
    v = vault_tables(spark, sf_dir)
    return v | {"hub_well": v["hub_well"].where("well_id % 2 = 0")}


@register("dq_orphans", _with(
    _refs_sql("link_survey_well", "hub_well_key", "hub_well", "link", EVEN_HUB) + "\nUNION ALL\n"
    + _refs_sql("link_survey_well", "hub_survey_key", "hub_survey", "link", "hub_survey")))
def q_dq_orphans(spark, sf_dir):
    checks = [C.references("link_survey_well", "hub_well_key", "hub_well"),
              C.references("link_survey_well", "hub_survey_key", "hub_survey")]
    return C.run_checks(spark, damaged_vault(spark, sf_dir), checks)


@register("dq_orphan_rows", _with(f"""
SELECT link_survey_well_key, hub_well_key FROM link
WHERE hub_well_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {EVEN_HUB} h WHERE h.hub_well_key = link.hub_well_key)"""))
def q_dq_orphan_rows(spark, sf_dir):
    """The links themselves whose well is missing, by anti join."""
    v = damaged_vault(spark, sf_dir)
    return C.orphans(v["link_survey_well"], "hub_well_key", v["hub_well"]).select("link_survey_well_key", "hub_well_key")


@register("dq_range", _with(_range_sql("sat_seismic_data", "depth", 10, "sat") + "\nUNION ALL\n"
                            + _range_sql("sat_seismic_data", "depth", 0, "sat")))
def q_dq_range(spark, sf_dir):
    v = vault_tables(spark, sf_dir, only=("readings",))
    return C.run_checks(spark, v, [C.at_least("sat_seismic_data", "depth", 10), C.at_least("sat_seismic_data", "depth", 0)])


_ERROR_SQL = "SELECT '{}' AS check_name, 'ERROR' AS status, CAST(NULL AS BIGINT) AS bad_rows, CAST(NULL AS BIGINT) AS total_rows, NULL AS detail"


DQ_SUITE_SQL = _with(
    _unique_sql("hub_survey", "hub_survey_key", "hub_survey") + "\nUNION ALL\n"
    + _refs_sql("link_survey_well", "hub_well_key", "hub_well", "link", EVEN_HUB) + "\nUNION ALL\n"
    + _range_sql("sat_seismic_data", "depth", 0, "sat") + "\nUNION ALL\n"
    + _ERROR_SQL.format("at_least:sat_seismic_data.ingest_source>=0") + "\nUNION ALL\n"
    + _ERROR_SQL.format("unique:no_such_table.key"))


def suite() -> list[C.Check]:
    """The vault's checks, one that fails while it runs and one whose table is missing."""
    return [*C.vault_checks(), C.at_least("sat_seismic_data", "ingest_source", 0), C.unique_key("no_such_table", "key")]


@register("dq_suite", DQ_SUITE_SQL)
def q_dq_suite(spark, sf_dir):
    """The vault's checks, one that fails while it runs and one whose table is missing."""
    out = C.run_checks(spark, damaged_vault(spark, sf_dir), suite())
    return out.withColumn("detail", F.when(F.col("status") != "ERROR", F.col("detail")))


@register("dq_in_flight", DQ_SUITE_SQL)
def q_dq_in_flight(spark, sf_dir):
    """The same checks along with the write of the vault: the range is observed while the satellite is written."""
    _, out = C.write_checked(spark, damaged_vault(spark, sf_dir), scratch_dir(spark, "checked"), suite())
    return out.withColumn("detail", F.when(F.col("status") != "ERROR", F.col("detail")))


TINY_CTES = VAULT_CTES.replace("readings AS (", "raw_readings AS (", 1).replace("surveys AS (", """readings AS (
  SELECT survey_id, well_id, depth,
         CASE WHEN well_id % 11 = 0 THEN NULL WHEN well_id = 1 THEN CAST('inf' AS DOUBLE) ELSE amplitude * 1e-12 END AS amplitude,
         quality_flag, ingest_timestamp
  FROM raw_readings UNION ALL
  SELECT survey_id, well_id, depth, CASE WHEN well_id % 11 = 0 THEN NULL WHEN well_id = 1 THEN CAST('inf' AS DOUBLE) ELSE amplitude * 1e-12 END,
         quality_flag, ingest_timestamp FROM raw_readings WHERE well_id % 5 = 0),
surveys AS (""", 1)


def tiny_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The inputs with amplitudes near 1e-8, some NULL, some infinite, and every fifth well's readings twice."""
    inp = analog.inputs(spark, sf_dir)
    a = F.when(F.col("well_id") % 11 == 0, None).when(F.col("well_id") == 1, float("inf")).otherwise(F.col("amplitude") * 1e-12)
    r = inp["readings"].withColumn("amplitude", a)
    return inp | {"readings": r.unionByName(r.where("well_id % 5 = 0"))}


@register("mart_tiny_values", "WITH " + TINY_CTES + MART_WELL_SQL)
def q_mart_tiny_values(spark, sf_dir):
    """Means of values far below a millionth, with NULL, infinite and equal readings."""
    return input_well_mart(tiny_inputs(spark, sf_dir))


@register("source_hash_tiny", "WITH " + TINY_CTES + f"""
SELECT survey_id, well_id, depth, quality_flag, {SRC_HASH_SQL} AS source_hash FROM readings""")
def q_source_hash_tiny(spark, sf_dir):
    r = tiny_inputs(spark, sf_dir)["readings"]
    return with_change_hash(r, ["depth", "amplitude", "quality_flag"], "source_hash").select(
        "survey_id", "well_id", "depth", "quality_flag", "source_hash")


@register("table_counts", _with(f"""
SELECT 'mart_well_performance' AS table_name, count(*) AS row_count FROM ({MART_WELL_SQL})
UNION ALL SELECT 'mart_sensor_analysis', count(*) FROM ({MART_SENSOR_SQL})
UNION ALL SELECT 'mart_survey_summary', count(*) FROM ({MART_SURVEY_SQL})"""))
def q_table_counts(spark, sf_dir):
    return C.table_counts(stored_marts(spark, sf_dir))
