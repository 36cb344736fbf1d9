"""Registered queries: reads as of a date, validity intervals, bucketed satellites, incremental marts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import history as H
from strata.operators.bucketed import BucketedSat
from strata.operators.incremental import IncrementalVault
from strata.operators.incremental_marts import DIMENSIONS, SAT, SKETCH_ERROR, IncrementalMarts
from strata.operators.marts import ts_text
from strata.operators.vault import build_hub, build_link, build_vault, seismic_sat, well_sat
from strata.plans.registry import register
from strata.plans.vault_queries import MART_SENSOR_SQL, MART_SURVEY_SQL, MART_WELL_SQL, SRC_HASH_SQL, TS_SQL, VAULT_CTES, WELLS_SURVEYED_SQL, _with, shown
from strata.session import scratch_dir
from strata.sources import analog

# Fixed load dates and the timestamps that part the readings into these loads.
LOADS = ("2024-01-01", "2024-02-01", "2024-03-01")
LOAD_CUTS = ("1994-01-01", "1997-01-01")
# Dates that are asked for: before all loads, between two, on one, after all.
DATES = ("2023-12-31", "2024-01-15", "2024-02-01", "2024-06-01")


def by_load(readings: DataFrame, column: str = "ingest_timestamp") -> list[tuple[str, DataFrame]]:
    """(load date, readings) of the three loads; readings without a timestamp come last."""
    first, second = (F.lit(c).cast("timestamp_ntz") for c in LOAD_CUTS)
    ts = F.col(column)
    return list(zip(LOADS, (readings.where(ts < first), readings.where((ts >= first) & (ts < second)),
                            readings.where((ts >= second) | ts.isNull()))))


def renamed_wells(wells: DataFrame, every: int, suffix: str) -> DataFrame:
    return wells.withColumn("operator", F.when(F.col("well_id") % every == 0, F.concat("operator", F.lit(suffix))).otherwise(F.col("operator")))


LOADED_CTES = f""",
loaded AS (
  SELECT survey_id, well_id, depth, amplitude, quality_flag, min(ingest_timestamp) AS ingest_timestamp,
         min(CASE WHEN ingest_timestamp < '{LOAD_CUTS[0]}' THEN '{LOADS[0]}' WHEN ingest_timestamp < '{LOAD_CUTS[1]}' THEN '{LOADS[1]}'
                  ELSE '{LOADS[2]}' END) AS load_date
  FROM readings WHERE survey_id IS NOT NULL AND well_id IS NOT NULL GROUP BY ALL)
"""


@register("vault_as_of", _with(LOADED_CTES + f""",
dates AS (SELECT unnest({list(DATES)}) AS as_of),
links AS (SELECT survey_id, well_id, min(load_date) AS born FROM loaded GROUP BY ALL),
link_rows AS (
  SELECT l.survey_id, l.well_id, as_of, r.load_date, r.depth, r.amplitude,
         row_number() OVER (PARTITION BY l.survey_id, l.well_id, as_of ORDER BY r.load_date DESC, r.ingest_timestamp DESC, r.source_hash DESC) AS nth
  FROM links l CROSS JOIN dates JOIN (SELECT *, {SRC_HASH_SQL} AS source_hash FROM loaded) r
    ON r.survey_id = l.survey_id AND r.well_id = l.well_id AND r.load_date <= as_of
  WHERE born <= as_of),
master AS (SELECT DISTINCT well_id, operator FROM wells WHERE well_id IS NOT NULL),
well_rows AS (
  SELECT well_id, '{LOADS[0]}' AS load_date, operator FROM master
  UNION ALL SELECT well_id, '{LOADS[1]}', operator || ' Ltd' FROM master WHERE well_id % 3 = 0
  UNION ALL SELECT well_id, '{LOADS[2]}', operator || ' AG' FROM master WHERE well_id % 5 = 0)
SELECT md5(CAST(survey_id AS VARCHAR) || '_' || CAST(well_id AS VARCHAR)) AS parent_key, as_of, load_date AS valid_from,
       CAST(NULL AS VARCHAR) AS operator, depth, amplitude
FROM link_rows WHERE nth = 1
UNION ALL
SELECT md5(CAST(well_id AS VARCHAR)), as_of, max(load_date), arg_max(operator, load_date), NULL, NULL
FROM well_rows CROSS JOIN dates WHERE load_date <= as_of GROUP BY well_id, as_of"""))
def q_vault_as_of(spark, sf_dir):
    """Three loads, then for every hub and link and four dates the satellite row that was valid."""
    vault = IncrementalVault(scratch_dir(spark, "as-of"))
    wells = analog.well_master(spark, sf_dir)
    # The third load renames every fifth well; the others keep what the second one brought.
    masters = (wells, renamed_wells(wells, 3, " Ltd"), renamed_wells(wells.where("well_id % 5 = 0"), 5, " AG"))
    for (date, rows), master in zip(by_load(analog.readings(spark, sf_dir)), masters):
        vault.load(spark, {
            "hub_well": build_hub(master, "well_id", "hub_well_key", date, "master_wells.csv"),
            "sat_well_details": well_sat(master, date),
            "link_survey_well": build_link(rows, "survey_id", "well_id", date),
            "sat_seismic_data": seismic_sat(rows, date, keep_source_timestamp=True, once=True)})
    none = F.lit(None)
    links = H.as_of(vault.table(spark, "link_survey_well"), vault.table(spark, "sat_seismic_data").drop("ingest_source"), "link_survey_well_key", DATES, H.READING_ORDER)
    hubs = H.as_of(vault.table(spark, "hub_well"), vault.table(spark, "sat_well_details"), "hub_well_key", DATES)
    return links.select(F.col("link_survey_well_key").alias("parent_key"), "as_of", "valid_from", none.cast("string").alias("operator"), "depth", "amplitude").unionByName(
        hubs.select(F.col("hub_well_key").alias("parent_key"), "as_of", "valid_from", "operator", none.cast("double").alias("depth"), none.cast("double").alias("amplitude")))


LATE = "2024-01-20"


@register("sat_effectivity", _with(f""",
master AS (SELECT DISTINCT well_id, well_name, operator FROM wells WHERE well_id IS NOT NULL),
events AS (
  SELECT well_id, well_name, operator, '{LOADS[0]}' AS load_date FROM master
  UNION ALL SELECT well_id, well_name, operator || CASE WHEN well_id % 3 = 0 THEN ' Ltd' ELSE '' END, '{LOADS[1]}' FROM master
  UNION ALL SELECT well_id, well_name, operator || CASE WHEN well_id % 6 = 0 THEN ' Ltd' ELSE '' END, '{LOADS[2]}' FROM master),
changes AS (SELECT * FROM events QUALIFY operator IS DISTINCT FROM lag(operator) OVER (PARTITION BY well_id ORDER BY load_date)),
hashed AS (
  SELECT *, md5(coalesce(well_name, 'null') || '_' || coalesce(operator, 'null') || '_null_null') AS content
  FROM (SELECT * FROM changes UNION ALL SELECT well_id, well_name, operator || ' Old', '{LATE}' FROM master WHERE well_id % 7 = 0)),
kept AS (SELECT * FROM hashed QUALIFY content IS DISTINCT FROM lag(content) OVER (PARTITION BY well_id ORDER BY load_date))
SELECT md5(md5(CAST(well_id AS VARCHAR)) || '_' || load_date || '_' || content) AS sat_hash_key,
       md5(CAST(well_id AS VARCHAR)) AS hub_well_key, well_name, operator, load_date,
       lead(load_date) OVER (PARTITION BY well_id ORDER BY load_date) AS valid_to
FROM kept"""))
def q_sat_effectivity(spark, sf_dir):
    """Well attributes by validity: a change, one that is taken back, the same batch again, and a batch that comes late."""
    sat = H.EffectivitySat(scratch_dir(spark, "effectivity"), ["hub_well_key"])
    wells = analog.well_master(spark, sf_dir)
    changed = renamed_wells(wells, 3, " Ltd")
    late = renamed_wells(wells.where("well_id % 7 = 0"), 7, " Old")
    for date, master in ((LOADS[0], wells), (LOADS[1], changed), (LOADS[1], changed), (LOADS[2], renamed_wells(wells, 6, " Ltd")), (LATE, late)):
        sat.load(well_sat(master, date))
    return sat.table(spark).select("sat_hash_key", "hub_well_key", "well_name", "operator", "load_date", "valid_to")


@register("incremental_sat_bucketed", _with(LOADED_CTES + f"""
SELECT md5(CAST(survey_id AS VARCHAR) || '_' || CAST(well_id AS VARCHAR)) AS link_survey_well_key, depth, amplitude, quality_flag,
       {SRC_HASH_SQL} AS source_hash, strftime(ingest_timestamp, {TS_SQL}) AS ingest_timestamp, load_date
FROM loaded"""))
def q_incremental_sat_bucketed(spark, sf_dir):
    """The readings satellite in buckets: three loads, the second one twice; no stored row is shuffled."""
    sat = BucketedSat(f"sat_seismic_{uuid.uuid4().hex[:12]}", scratch_dir(spark, "bucketed-sat"), buckets=16)
    loads = by_load(analog.readings(spark, sf_dir))
    for date, rows in [loads[0], loads[1], *loads[1:]]:
        sat.load(seismic_sat(rows, date, keep_source_timestamp=True, once=True))
    return sat.table(spark).select("link_survey_well_key", "depth", "amplitude", "quality_flag", "source_hash",
                                   ts_text(F.col("ingest_timestamp")).alias("ingest_timestamp"), "load_date")


# The vault keeps one of equal readings of a link: the one that came first.
ONCE_CTES = VAULT_CTES.replace("readings AS (", "raw_readings AS (", 1).replace("surveys AS (", """readings AS (
  SELECT survey_id, well_id, depth, amplitude, quality_flag, min(ingest_timestamp) AS ingest_timestamp FROM raw_readings GROUP BY ALL),
surveys AS (""", 1)


def loaded_marts(spark, sf_dir) -> IncrementalMarts:
    """A vault with partials and sketches after three loads, the second one twice."""
    inp = analog.inputs(spark, sf_dir)
    store = IncrementalMarts(scratch_dir(spark, "inc-marts"))
    loads = by_load(inp["readings"])
    for date, rows in [loads[0], loads[1], *loads[1:]]:
        first = date == LOADS[0]  # the masters come with the first load
        tables = build_vault(inp["surveys"] if first else None, inp["wells"] if first else None, rows, date, keep_source_timestamp=True, once=True)
        store.load(spark, {name: df for name, df in tables.items() if name in (*DIMENSIONS, SAT)}, date)
    return store


def incremental_marts(spark, sf_dir) -> dict[str, DataFrame]:
    """The three marts from the partials that the loads left beside the vault."""
    return {k: shown(v) for k, v in loaded_marts(spark, sf_dir).marts(spark).items()}


@register("wells_surveyed_sketch", _with(f"""
SELECT survey_type_id, wells_surveyed_count, true AS within_error FROM ({WELLS_SURVEYED_SQL})"""))
def q_wells_surveyed_sketch(spark, sf_dir):
    """Distinct wells per survey: the exact count, and whether the merged sketches of all loads come within the stated error."""
    out = loaded_marts(spark, sf_dir).wells_surveyed(spark)
    return out.select("survey_type_id", "wells_surveyed_count", (F.col("error") <= SKETCH_ERROR).alias("within_error"))


@register("mart_incremental", "WITH " + ONCE_CTES + MART_SURVEY_SQL)
def q_mart_incremental(spark, sf_dir):
    return incremental_marts(spark, sf_dir)["mart_survey_summary"]


@register("mart_incremental_wells", "WITH " + ONCE_CTES + MART_WELL_SQL)
def q_mart_incremental_wells(spark, sf_dir):
    return incremental_marts(spark, sf_dir)["mart_well_performance"]


@register("mart_incremental_sensors", "WITH " + ONCE_CTES + MART_SENSOR_SQL)
def q_mart_incremental_sensors(spark, sf_dir):
    return incremental_marts(spark, sf_dir)["mart_sensor_analysis"]
