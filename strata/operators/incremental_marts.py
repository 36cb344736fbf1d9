"""Marts kept up to date by loads, without reading the stored readings again.

Beside the vault lies a table of mergeable partials per link (counts, sums,
least and greatest timestamps): each load adds the partials of the satellite
rows that it stores, in a folder of its own.  A link may have a row per load;
all roll-ups of ``marts`` add partials up anyway, so the marts come from that
table and the dimensions alone.

A load is counted once it is committed: its partials are written first (the
folder is named by the load and overwritten when a load is played again), then
the satellite rows, then a commit row.  Readers trust commit rows only.  A load
that failed after its satellite rows were stored finds nothing new when it is
played again, keeps the partials that it wrote before, and commits them.

Distinct wells per survey cannot be added up, but sketches of them can be
merged: each load leaves one HLL sketch per survey of the links that it brings,
so the number over all loads is estimated without reading the link table.  A
link that comes again changes no sketch, so a load may be played again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import packed, unpacked
from strata.operators.incremental import FRESH, IncrementalVault, _digests, _staged, read_stored
from strata.operators.marts import _aggregates, _attach_dims, build_marts, wells_surveyed
from strata.session import scratch_dir
from strata.sinks.tables import write_parquet
from strata.sources.files import path_exists, remove_tree

SAT, LINK = "sat_seismic_data", "link_survey_well"
LINK_KEY = "link_survey_well_key"
#: log2 of a sketch's registers; the relative standard error is 1.04 / sqrt(2^LG_K), and the stated bound five times that.
LG_K = 14
SKETCH_ERROR = 5 * 1.04 / 2 ** (LG_K / 2)
DIMENSIONS = ("link_survey_well", "hub_well", "hub_survey", "sat_survey_details")


def _binary(df: DataFrame) -> DataFrame:
    return df.withColumns({c: packed(F.col(c)) for c in _digests(df, [])})


def survey_sketches(links: DataFrame) -> DataFrame:
    """One sketch of the distinct wells per survey (at most 2^LG_K bytes and a header); combined in the map tasks."""
    return links.groupBy("hub_survey_key").agg(F.hll_sketch_agg("hub_well_key", LG_K).alias("wells"))


def estimated_wells(sketches: DataFrame) -> DataFrame:
    """(hub_survey_key, wells_estimate) from the sketches of any number of loads."""
    return sketches.groupBy("hub_survey_key").agg(F.hll_sketch_estimate(F.hll_union_agg("wells")).alias("wells_estimate"))


class IncrementalMarts:
    """An incrementally loaded vault with partials of its readings."""

    def __init__(self, root: str):
        self.vault = IncrementalVault(root)
        self.facts_path, self.commits_path = self.vault.path("link_facts"), self.vault.path("link_facts_commits")
        self.sketch_path = self.vault.path("survey_sketches")

    def load(self, spark: SparkSession, tables: dict[str, DataFrame], load_id: str) -> dict[str, int]:
        """Load one batch of vault tables under an id of its own (letters, digits, ``-`` and ``_``); rows added per table."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", load_id):
            raise ValueError(f"not a load id: {load_id!r}")
        others = {k: v for k, v in tables.items() if k != SAT}
        if LINK in tables:
            write_parquet(survey_sketches(tables[LINK]), f"{self.sketch_path}/load={load_id}")
        added = self.vault.load(spark, others)
        if SAT in tables:
            copies = scratch_dir(spark, "load")
            fresh = _staged(FRESH[SAT](tables[SAT], read_stored(spark, self.vault.path(SAT)), copies), copies)
            added[SAT] = fresh.count()
            if added[SAT]:
                partials = fresh.groupBy(packed(F.col(LINK_KEY)).alias(LINK_KEY)).agg(*_aggregates())
                partials = partials.withColumn(LINK_KEY, unpacked(F.col(LINK_KEY)))
                write_parquet(partials, f"{self.facts_path}/load={load_id}")
                write_parquet(fresh, self.vault.path(SAT), mode="append")
            remove_tree(spark, copies)
            if path_exists(spark, f"{self.facts_path}/load={load_id}"):
                spark.createDataFrame([(added[SAT],)], "rows bigint").write.mode("overwrite").parquet(f"{self.commits_path}/load={load_id}")
        return {name: added[name] for name in tables}

    def partials(self, spark: SparkSession) -> DataFrame:
        """The committed partials: a row per link and load that brought readings of it."""
        commits = spark.read.option("basePath", self.commits_path).parquet(self.commits_path)
        ids = [r.load for r in commits.select(F.col("load").cast("string")).distinct().collect()]  # a row per load
        folders = [f"{self.facts_path}/load={i}" for i in sorted(ids)]
        return spark.read.parquet(*folders)

    def merged(self, spark: SparkSession) -> DataFrame:
        """One row of partials per link, to replace those of many loads."""
        sums = [F.sum(c).alias(c) for c in ("n_depth", "n_amp", "amp_sum", "n_flags")]
        return self.partials(spark).groupBy(LINK_KEY).agg(*sums, F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))

    def dimensions(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The tables that the marts join, with keys as binary: no mart shows one."""
        return {name: _binary(self.vault.table(spark, name)) for name in DIMENSIONS}

    def wells_surveyed(self, spark: SparkSession) -> DataFrame:
        """(survey_type_id, wells_surveyed_count, wells_estimate, error): the exact count beside the sketches' one, and the relative difference."""
        exact = wells_surveyed(self.dimensions(spark))
        hub = self.vault.table(spark, "hub_survey").select("hub_survey_key", "survey_type_id")
        found = estimated_wells(spark.read.parquet(self.sketch_path)).join(hub, "hub_survey_key").drop("hub_survey_key")
        return exact.join(found, "survey_type_id").withColumn("error", F.abs(F.col("wells_estimate") / F.col("wells_surveyed_count") - 1))

    def marts(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The three marts, from the partials and the dimensions."""
        vault = self.dimensions(spark)
        return build_marts(vault, facts=_attach_dims(_binary(self.partials(spark)), vault))
