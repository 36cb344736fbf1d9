"""Data-vault loaders: hubs, links and satellites as lazy DataFrames.

Every builder returns a plan, not data; nothing here triggers a job.  Keys are
built-in expressions (``strata.functions.keys``).  Distinct sets are taken on
the narrow business keys before hashing, so the shuffle carries two integers
per row instead of three 32-character digests, and md5 runs once per distinct
key instead of once per reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.keys import md5_key, not_null, sha256_key, with_change_hash
from strata.plans.joins import set_bound, set_unique

# Fixed values of the vault layout.
SURVEY_SOURCE = "master_surveys.csv"
WELL_SOURCE = "master_wells.csv"
READING_SOURCE = "sgx_reconstruction"
SOURCE_FORMAT_CANDIDATES = ("source_format", "file_format", "format")
DEFAULT_SOURCE_FORMAT = "csv"
READING_HASH_COLUMNS = ("depth", "amplitude", "quality_flag")
SAT_INPUTS = ("survey_id", "well_id", *READING_HASH_COLUMNS, "ingest_timestamp")


def hash_fn(kind: str):
    if kind == "md5":
        return md5_key
    if kind == "sha256":
        return sha256_key
    raise ValueError(f"unknown key hash {kind!r}")


def stored_key(key: Column) -> Column:
    """A hash key over inputs already filtered to non-NULL, declared non-nullable.

    The value is unchanged (a digest of non-NULL text is never NULL).  Without
    the declaration Catalyst infers ``IsNotNull(md5(...))`` for every join on
    the key and evaluates it as an extra filter, hashing each row twice.
    """
    return F.coalesce(key, F.lit(""))


def pick_column(df: DataFrame, candidates: Sequence[str], default: str) -> Column:
    """First column of ``candidates`` present in ``df``, else a constant.

    Decided on the driver from the schema; candidate order matters.
    """
    for name in candidates:
        if name in df.columns:
            return F.col(name)
    return F.lit(default)


def rejects(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Rows whose business key is NULL: they cannot be hashed into a hub or link."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.where(cond).select(
        F.lit(table).alias("target_table"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("record"),
    )


def _whole(df: DataFrame, *cols: str) -> bool:
    """Whether the columns are whole numbers, so that different values have different key texts."""
    return all(isinstance(df.schema[c].dataType, T.IntegralType) for c in cols)


def build_hub(df: DataFrame, key: str, hub_key: str, load_ts: str,
              record_source: str, key_hash: str = "md5") -> DataFrame:
    """HUB: one row per distinct business key with its hash and audit columns."""
    hub = (df.select(key).where(F.col(key).isNotNull()).distinct()
           .select(stored_key(hash_fn(key_hash)(key)).alias(hub_key), key,
                   F.lit(load_ts).alias("load_date"),
                   F.lit(record_source).alias("record_source")))
    return set_unique(hub, [hub_key]) if _whole(df, key) else hub


def build_sat(df: DataFrame, parent_key: str, parent_cols: Sequence[str],
              attrs: Sequence[str | Column], load_ts: str, key_hash: str = "md5",
              not_null_cols: Sequence[str] | None = None) -> DataFrame:
    """SAT: parent hash key plus descriptive attributes and the load date.

    Rows are not deduplicated (a satellite keeps what arrived).
    """
    h = hash_fn(key_hash)
    keep = not_null(*(not_null_cols if not_null_cols is not None else parent_cols))
    return df.where(keep).select(stored_key(h(*parent_cols)).alias(parent_key), *attrs,
                                 F.lit(load_ts).alias("load_date"))


def build_link(df: DataFrame, survey_col: str, well_col: str, load_ts: str,
               record_source: str = READING_SOURCE, key_hash: str = "md5") -> DataFrame:
    """LINK survey-well: distinct pairs, then the pair hash and both parent hashes."""
    h = hash_fn(key_hash)
    pairs = (df.select(survey_col, well_col)
               .where(not_null(survey_col, well_col))
               .distinct())
    link = pairs.select(
        stored_key(h(survey_col, well_col)).alias("link_survey_well_key"),
        stored_key(h(survey_col)).alias("hub_survey_key"),
        stored_key(h(well_col)).alias("hub_well_key"),
        F.lit(load_ts).alias("load_date"),
        F.lit(record_source).alias("record_source"),
    )
    return set_unique(link, ["link_survey_well_key"]) if _whole(df, survey_col, well_col) else link


def survey_sat(surveys: DataFrame, load_ts: str, key_hash: str = "md5") -> DataFrame:
    fmt = pick_column(surveys, SOURCE_FORMAT_CANDIDATES, DEFAULT_SOURCE_FORMAT)
    return build_sat(surveys, "hub_survey_key", ["survey_type_id"],
                     ["survey_type", "survey_type_id", fmt.alias("source_format")],
                     load_ts, key_hash)


def well_sat(wells: DataFrame, load_ts: str, key_hash: str = "md5") -> DataFrame:
    return build_sat(wells, "hub_well_key", ["well_id"],
                     ["well_name", "operator", "location_lat", "location_long"],
                     load_ts, key_hash)


def seismic_sat(readings: DataFrame, load_ts: str, key_hash: str = "md5",
                keep_source_timestamp: bool = False, once: bool = False) -> DataFrame:
    """SAT of readings keyed by the link; ``source_hash`` is the change hash of the reading.

    The hash covers depth, amplitude and flag only (no ids), so equal readings
    in different links share it by design.  By default the ingest columns are
    stamped with the load (the reference behaviour); ``keep_source_timestamp``
    keeps a timestamp the source already carries.  ``once``: of equal readings
    of a link the earliest alone, found by their numbers before any text is
    made of them (readings of other types than numbers are left as they are).
    """
    once = once and _whole(readings, "survey_id", "well_id", "quality_flag") and all(
        isinstance(readings.schema[c].dataType, T.DoubleType) for c in ("depth", "amplitude"))
    if once:
        first = F.min(F.col("ingest_timestamp") if "ingest_timestamp" in readings.columns else F.lit(None).cast("timestamp_ntz"))
        readings = (readings.where(not_null("survey_id", "well_id")).groupBy("survey_id", "well_id", *READING_HASH_COLUMNS)
                    .agg(first.alias("ingest_timestamp")).select(*[c for c in readings.columns if c in SAT_INPUTS]))
    ts = (F.col("ingest_timestamp") if keep_source_timestamp and "ingest_timestamp" in readings.columns
          else F.lit(load_ts).cast("timestamp_ntz"))
    h = hash_fn(key_hash)
    hashed = with_change_hash(readings.where(not_null("survey_id", "well_id")), READING_HASH_COLUMNS, "source_hash")
    sat = (hashed
           .select(stored_key(h("survey_id", "well_id")).alias("link_survey_well_key"),
                   "depth", "amplitude", "quality_flag",
                   F.lit(READING_SOURCE).alias("ingest_source"),
                   "source_hash",
                   ts.alias("ingest_timestamp"),
                   F.lit(load_ts).alias("load_date")))
    return set_unique(sat, ["link_survey_well_key", "source_hash"]) if once else sat


def build_vault(surveys: DataFrame | None, wells: DataFrame | None, readings: DataFrame | None,
                load_ts: str, key_hash: str = "md5",
                keep_source_timestamp: bool = False, once: bool = False) -> dict[str, DataFrame]:
    """The whole raw vault as lazy DataFrames; absent inputs give absent tables (``once``: see ``seismic_sat``)."""
    out: dict[str, DataFrame] = {}
    rej: list[DataFrame] = []
    if surveys is not None:
        out["hub_survey"] = set_bound(build_hub(surveys, "survey_type_id", "hub_survey_key", load_ts,
                                                SURVEY_SOURCE, key_hash), surveys)
        out["sat_survey_details"] = set_bound(survey_sat(surveys, load_ts, key_hash), surveys)
        rej.append(rejects(surveys, ["survey_type_id"], "hub_survey"))
    if wells is not None:
        out["hub_well"] = set_bound(build_hub(wells, "well_id", "hub_well_key", load_ts, WELL_SOURCE,
                                              key_hash), wells)
        out["sat_well_details"] = set_bound(well_sat(wells, load_ts, key_hash), wells)
        rej.append(rejects(wells, ["well_id"], "hub_well"))
    if readings is not None:
        out["link_survey_well"] = set_bound(build_link(readings, "survey_id", "well_id", load_ts,
                                                       READING_SOURCE, key_hash), readings)
        out["sat_seismic_data"] = set_bound(seismic_sat(readings, load_ts, key_hash, keep_source_timestamp, once), readings)
        rej.append(rejects(readings, ["survey_id", "well_id"], "link_survey_well"))
    if rej:
        r = rej[0]
        for x in rej[1:]:
            r = r.unionByName(x)
        out["rejects"] = r
    return out
