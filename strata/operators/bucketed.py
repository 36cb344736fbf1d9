"""A readings satellite stored in buckets, so that a load never moves a stored row.

``IncrementalVault`` broadcasts the keys of a batch when they are few.  A batch
too large for that would shuffle the stored keys on every load.  Here the
satellite is a catalog table whose files are bucketed by parent key and change
hash: the anti join of a load hashes the batch into the same buckets and reads
the stored ones as they lie.  The hash is part of the bucket key, so a parent
that holds a third of all readings is spread over all buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.incremental import CODEC, _first_of_each
from strata.sources.files import path_exists


class BucketedSat:
    """Table ``name`` with its files at ``path``; both must be this satellite's own."""

    def __init__(self, name: str, path: str, parent_key: str = "link_survey_well_key", hash_col: str = "source_hash",
                 buckets: int = 64, order: str = "ingest_timestamp"):
        self.name, self.path, self.buckets, self.order = name, path, buckets, order
        self.keys = [parent_key, hash_col]

    def attach(self, spark: SparkSession) -> bool:
        """Whether there is a table; files without one (a new session's catalog) get their entry back."""
        if spark.catalog.tableExists(self.name):
            return True
        if not path_exists(spark, self.path):
            return False
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(self.path).schema)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        return True

    def table(self, spark: SparkSession) -> DataFrame:
        if not self.attach(spark):
            raise FileNotFoundError(f"nothing loaded into {self.name}")
        return spark.table(self.name)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """One row per (parent, change hash) of the batch that is not stored; of equal readings the earliest."""
        rows = _first_of_each(batch, self.keys, [self.order] if self.order in batch.columns else [])
        if not self.attach(batch.sparkSession):
            return rows
        stored = batch.sparkSession.table(self.name).select(*self.keys)
        return rows.join(stored.hint("merge"), self.keys, "left_anti").select(*batch.columns)

    def load(self, batch: DataFrame) -> int:
        """Append what is new; returns the rows added.  A batch played again adds nothing."""
        rows = Observation()
        # A task per bucket: one file each, not buckets x tasks.  Behind the join rows lie so already and do not move again.
        (self.unseen(batch).repartition(self.buckets, *self.keys).observe(rows, F.count(F.lit(1)).alias("rows"))
         .write.mode("append").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
         .option("path", self.path).option("compression", CODEC).saveAsTable(self.name))
        return int(rows.get["rows"])
