"""Aggregate marts over the vault.

Every mart metric is decomposable (counts, exact sums, min, max), and every
mart dimension depends only on the link key.  So the readings satellite — the
only table that grows with the data — is aggregated once per link
(``link_facts``): a map-side partial aggregate, one shuffle on the link key,
and from then on one row per link instead of one per reading.  The small
result is joined to the link, hub and survey tables and rolled up three
times.  A hot link (one key holding a third of all readings) costs nothing
extra: partial aggregation collapses it in every map task before the shuffle.

``core_facts`` is the direct form (one row per reading, the reference's
joined frame) expressed in the same partial columns, so both forms share the
roll-ups and agree exactly.

``facts_from_inputs`` builds the same partials straight from the inputs: the
readings are scanned once and grouped by their two integer keys, and that one
grouped frame yields the links, the partials and the wells per survey.

``well_performance_from_inputs`` builds the well mart alone, whose groups are
too many to be held beside the links': a reading gets its survey's format and
goes straight into the group of its well, so a task holds one table of groups.

Means are those of the double values, as pandas computes them: a sum and a
count are carried through the roll-ups and divided once at the end; an
infinity stays one.  Sums of doubles depend on their order in the last bits,
so comparisons across engines round the result (``round_sig``), never the input.
Ratios use ``try_divide``: a group without readings gives NULL, not an error.
Group keys are filtered ``IS NOT NULL`` first, as pandas ``groupby`` drops
NULL keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.keys import not_null, packed, unpacked
from strata.operators.vault import DEFAULT_SOURCE_FORMAT, SOURCE_FORMAT_CANDIDATES, pick_column
from strata.plans.joins import bound_of, maybe_broadcast, salted_join

TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
HASH_KEYS = ("link_survey_well_key", "hub_survey_key", "hub_well_key")
MART_NAMES = ("mart_well_performance", "mart_sensor_analysis", "mart_survey_summary")


def _dim(vault: dict[str, DataFrame], name: str, *cols: str, distinct: bool = False) -> DataFrame:
    """A narrow projection of a dimension, broadcast when its size is bounded."""
    src = vault[name]
    df = _short_keys(src.select(*cols))
    if distinct:
        df = df.distinct()
    return maybe_broadcast(df, bound_source=bound_of(src) or src)


def _short_keys(df: DataFrame, *only: str) -> DataFrame:
    """``df`` for inner joins on its hash keys, or ``only`` some: they move as ``packed`` binary; NULL ones match nothing and go."""
    keys = [f.name for f in df.schema.fields if f.name in (only or HASH_KEYS) and isinstance(f.dataType, T.StringType)]
    return df.where(not_null(*keys)).withColumns({k: F.coalesce(packed(F.col(k)), F.lit(b"")) for k in keys}) if keys else df


def _text_keys(df: DataFrame) -> DataFrame:
    """What ``_short_keys`` made short as the texts they were."""
    return df.withColumns({f.name: unpacked(F.col(f.name)) for f in df.schema.fields
                           if f.name in HASH_KEYS and isinstance(f.dataType, T.BinaryType)})


def _attach_dims(facts: DataFrame, vault: dict[str, DataFrame], salts: int = 1) -> DataFrame:
    """facts(link key, ...) ⋈ link ⋈ hub_well ⋈ hub_survey ⟕ survey satellite."""
    link = vault["link_survey_well"].select("link_survey_well_key", "hub_survey_key", "hub_well_key")
    out = salted_join(_short_keys(facts), _short_keys(link), "link_survey_well_key", salts)
    out = out.join(_dim(vault, "hub_well", "hub_well_key", "well_id"), "hub_well_key")
    out = out.join(_dim(vault, "hub_survey", "hub_survey_key", "survey_type_id"), "hub_survey_key")
    # Two formats for one survey id multiply its readings, as the reference's merge does.
    survey_sat = _dim(vault, "sat_survey_details", "survey_type_id", "survey_type", "source_format",
                      distinct=True)
    return _text_keys(out.join(survey_sat, "survey_type_id", "left"))


def _partials() -> list[Column]:
    return [
        F.col("depth").isNotNull().cast("bigint").alias("n_depth"),
        F.col("amplitude").isNotNull().cast("bigint").alias("n_amp"),
        F.col("amplitude").cast("double").alias("amp_sum"),
        F.when(F.col("quality_flag") == 1, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("n_flags"),
        F.col("ingest_timestamp").alias("min_ts"),
        F.col("ingest_timestamp").alias("max_ts"),
    ]


def core_join(vault: dict[str, DataFrame], salts: int | None = None) -> DataFrame:
    """The joined reading-level frame: one row per reading and survey format.

    The readings ⋈ link join is the one join whose streamed side can be
    skewed (a hot link); ``salts`` (default: conf ``strata.join.salts``, 1)
    spreads each hot link (``joins.hot_keys``) over that many partitions.
    """
    sat = vault["sat_seismic_data"].select("link_survey_well_key", "depth", "amplitude",
                                           "quality_flag", "ingest_timestamp")
    if salts is None:
        salts = int(sat.sparkSession.conf.get("strata.join.salts", "1"))
    return _attach_dims(sat, vault, salts)


def core_facts(vault: dict[str, DataFrame]) -> DataFrame:
    """Direct form: reading-level partials (no pre-aggregation)."""
    sat = vault["sat_seismic_data"]
    return _attach_dims(sat.select("link_survey_well_key", *_partials()), vault)


def _aggregates() -> list[Column]:
    return [
        F.count("depth").alias("n_depth"),
        F.count("amplitude").alias("n_amp"),
        F.sum(F.col("amplitude").cast("double")).alias("amp_sum"),
        F.count_if(F.col("quality_flag") == 1).alias("n_flags"),
        F.min("ingest_timestamp").alias("min_ts"),
        F.max("ingest_timestamp").alias("max_ts"),
    ]


def link_facts(vault: dict[str, DataFrame]) -> DataFrame:
    """Pre-aggregated form: one row of partials per link, then the dimensions."""
    sat = _short_keys(vault["sat_seismic_data"].select("link_survey_well_key", "depth", "amplitude", "quality_flag", "ingest_timestamp"))
    return _attach_dims(sat.groupBy("link_survey_well_key").agg(*_aggregates()), vault)


def _survey_formats(surveys: DataFrame) -> DataFrame:
    """The formats of each survey id, one row each: two multiply the survey's readings."""
    fmt = pick_column(surveys, SOURCE_FORMAT_CANDIDATES, DEFAULT_SOURCE_FORMAT)
    return (surveys.where("survey_type_id is not null")
            .select("survey_type_id", "survey_type", fmt.alias("source_format")).distinct())


def facts_from_inputs(surveys: DataFrame, wells: DataFrame, readings: DataFrame) -> DataFrame:
    """The partials of every link and survey format from one scan of the readings.

    Joins are on the integer business keys, which match exactly when their
    hashes do.  Links to wells missing from the master stay, with ``in_hub``
    NULL: they count as surveyed wells but not in the metrics.
    """
    per_link = (readings.where(not_null("survey_id", "well_id"))
                .groupBy("survey_id", "well_id").agg(*_aggregates()))
    hub_well = wells.select("well_id").where("well_id is not null").distinct().withColumn("in_hub", F.lit(True))
    return (per_link.withColumnRenamed("survey_id", "survey_type_id")
            .join(maybe_broadcast(_survey_formats(surveys), bound_source=surveys), "survey_type_id")
            .join(maybe_broadcast(hub_well, bound_source=wells), "well_id", "left"))


def _metrics(with_rate: bool = True) -> list[Column]:
    total = F.sum("n_depth")
    cols = [
        total.alias("total_readings"),
        F.try_divide(F.sum("amp_sum"), F.sum("n_amp")).alias("avg_amplitude"),
    ]
    if with_rate:
        cols.append(F.try_divide(F.sum("n_flags").cast("double"), total).alias("data_quality_rate"))
    return cols


def _keys_present(df: DataFrame, *keys: str) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


def mart_well_performance(facts: DataFrame) -> DataFrame:
    return (_keys_present(facts, "well_id", "source_format")
            .groupBy("well_id", "source_format").agg(*_metrics()))


def well_performance_from_inputs(surveys: DataFrame, wells: DataFrame, readings: DataFrame) -> DataFrame:
    """``mart_well_performance`` from one scan of the readings and one aggregate, by well and format.

    By way of the links a task would hold its links' partials and its wells'
    at once.  Wells missing from the master are dropped last, where a well has
    one row per format.
    """
    survey = _survey_formats(surveys).select("survey_type_id", "source_format")
    facts = (readings.where(not_null("survey_id", "well_id")).withColumnRenamed("survey_id", "survey_type_id")
             .join(maybe_broadcast(survey, bound_source=surveys), "survey_type_id")
             .select("well_id", "source_format", *_partials()))
    hub_well = wells.select("well_id").where("well_id is not null")
    return mart_well_performance(facts).join(maybe_broadcast(hub_well), "well_id", "left_semi")


def mart_sensor_analysis(facts: DataFrame) -> DataFrame:
    return _keys_present(facts, "survey_type").groupBy("survey_type").agg(*_metrics())


def wells_surveyed(vault: dict[str, DataFrame], approximate: bool = False) -> DataFrame:
    """Distinct wells per survey id, from the link table (not from readings).

    ``count_distinct`` dedups (survey, well) pairs itself (map-side, then a
    partial count per survey), so no separate ``distinct`` pass over the link
    table is needed.
    """
    link = _short_keys(vault["link_survey_well"].select("hub_survey_key", "hub_well_key"), "hub_survey_key")
    hub_survey = _dim(vault, "hub_survey", "hub_survey_key", "survey_type_id")
    return (link.join(hub_survey, "hub_survey_key")
                .where(F.col("survey_type_id").isNotNull())
                .groupBy("survey_type_id")
                .agg((F.approx_count_distinct if approximate else F.count_distinct)("hub_well_key").alias("wells_surveyed_count")))


def ts_text(c: Column) -> Column:
    return F.date_format(c, TIMESTAMP_TEXT)


def _summary_columns(df: DataFrame) -> DataFrame:
    return df.select("survey_type", "source_format", "wells_surveyed_count", "total_readings", "avg_amplitude",
                     ts_text(F.col("earliest_ts")).alias("earliest_timestamp"),
                     ts_text(F.col("latest_ts")).alias("latest_timestamp"))


def mart_survey_summary(facts: DataFrame, vault: dict[str, DataFrame]) -> DataFrame:
    metrics = (_keys_present(facts, "survey_type", "source_format", "survey_type_id")
               .groupBy("survey_type", "source_format", "survey_type_id")
               .agg(*_metrics(with_rate=False),
                    F.min("min_ts").alias("earliest_ts"),
                    F.max("max_ts").alias("latest_ts")))
    return (metrics.join(wells_surveyed(vault), "survey_type_id", "left")
            .transform(_summary_columns))


def build_marts(vault: dict[str, DataFrame], preaggregate: bool = True,
                facts: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three marts. Pass ``facts`` to reuse a stored per-link table."""
    if facts is None:
        facts = link_facts(vault) if preaggregate else core_facts(vault)
    return {
        "mart_well_performance": mart_well_performance(facts),
        "mart_sensor_analysis": mart_sensor_analysis(facts),
        "mart_survey_summary": mart_survey_summary(facts, vault),
    }


def marts_from_facts(facts: DataFrame) -> dict[str, DataFrame]:
    """The three marts from ``facts_from_inputs``: each a roll-up of that frame alone."""
    known = facts.where("in_hub")
    keys = ("survey_type", "source_format", "survey_type_id")
    shown = {c: F.when(F.col("in_hub"), F.col(c)) for c in ("n_depth", "n_amp", "amp_sum", "min_ts", "max_ts")}
    # A survey's links appear once per format, so their number in a group is that of its wells.
    summary = (_keys_present(facts, *keys).withColumns(shown).groupBy(*keys)
               .agg(F.count(F.lit(1)).alias("wells_surveyed_count"), F.count("in_hub").alias("in_hub"),
                    *_metrics(with_rate=False), F.min("min_ts").alias("earliest_ts"), F.max("max_ts").alias("latest_ts"))
               .where("in_hub > 0"))
    return {
        "mart_well_performance": mart_well_performance(known),
        "mart_sensor_analysis": mart_sensor_analysis(known),
        "mart_survey_summary": _summary_columns(summary),
    }


def round_sig(c: str | Column, bits: int = 34) -> Column:
    """A double to so many significant bits, for comparing results across engines.

    Means of values with a few decimals often end in a 5 and would be ties on
    a decimal grid; on a binary one they are not.
    """
    x = F.col(c) if isinstance(c, str) else c
    p = F.pow(F.lit(2.0), bits - 1 - F.floor(F.log2(F.abs(x))))
    plain = x.isNull() | F.isnan(x) | (x == 0) | (F.abs(x) == float("inf"))
    return F.when(plain, x).otherwise(F.floor(x * p + 0.5) / p)


def mart_preview(mart: DataFrame, keys: list[str], n: int = 20) -> DataFrame:
    """Presentation order and the documented ``LIMIT 20`` (top-k, not a sample)."""
    return mart.orderBy(*keys).limit(n)
