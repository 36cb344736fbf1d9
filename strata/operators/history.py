"""History of the vault: reads as of a load date, and satellites with validity intervals.

**Reads as of a date.**  ``as_of`` answers, for every parent (hub or link) that
was loaded by a date, which satellite row was valid then: the last one loaded.
All dates are answered in one aggregate over parents and satellite rows
together, so there is one shuffle per satellite and no join of versions with
each other; the maxima are combined in every map task first, so a parent that
holds a third of all rows costs nothing extra.  ``vault_as_of`` gives the whole
vault as of a date, as tables that the checks and marts take like any vault.

**Intervals.**  ``EffectivitySat`` keeps, per parent, one row for each stretch
of time in which its attributes did not change, from ``load_date`` up to
``valid_to`` (NULL: still valid), under a satellite key made of parent key,
load date and content.  A load rewrites only the parents whose history it
changes: it publishes their rows as the next version, and of each parent only
the rows of its last version count.  A batch that is played again, or brings
nothing new, publishes nothing.  Batches may come late: a row that belongs
between stored ones splits the interval it falls in, and holds until the next
stored change (that a later load brought the same content again is not stored).

Ties: of several rows of a parent with one load date the greatest by content
digest counts (``as_of``: by the given order).  A row with a NULL key is not
stored; it belongs to the rejects.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.keys import md5_key, packed, unpacked, with_change_hash
from strata.operators.vault import stored_key
from strata.plans.joins import byte_bound, max_broadcast_bytes
from strata.session import scratch_dir
from strata.sinks import versions as SV
from strata.sources.files import path_exists

LOAD_DATE = "load_date"
#: What orders the rows of one load, where a satellite may hold several per parent.
READING_ORDER = ("ingest_timestamp", "source_hash", "depth", "amplitude", "quality_flag")
#: Satellite -> (parent table, parent key, what identifies a row besides its parent).
SATELLITES: dict[str, tuple[str, str, tuple[str, ...]]] = {
    "sat_survey_details": ("hub_survey", "hub_survey_key", ("source_format",)),
    "sat_well_details": ("hub_well", "hub_well_key", ()),
}


def as_of(parent: DataFrame, sat: DataFrame, key: str, dates: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """(key, as_of, valid_from, the satellite's other columns): a row per parent and date by which it was loaded.

    ``order`` breaks ties of the load date, the greatest wins.  A parent
    without a satellite row by then has NULLs; a satellite row without a
    parent is left out.  ``dates`` is a short list, a parameter: each costs a
    column of the aggregate.
    """
    payload = [c for c in sat.columns if c not in (key, LOAD_DATE)]
    text = isinstance(sat.schema[key].dataType, T.StringType) and isinstance(parent.schema[key].dataType, T.StringType)
    if text:  # shuffled as binary
        parent, sat = (df.withColumn(key, packed(F.col(key))) for df in (parent, sat))
    # Compared from the left: load date, the given order, the rest; each column stands there once.
    row = F.struct(F.col(LOAD_DATE).alias("valid_from"), *[F.col(c) for c in order], *[F.col(c) for c in payload if c not in order])
    rows = sat.select(key, F.lit(None).cast(parent.schema[LOAD_DATE].dataType).alias("__born"), row.alias("__row"))
    both = parent.select(key, F.col(LOAD_DATE).alias("__born"), F.lit(None).cast(rows.schema["__row"].dataType).alias("__row")).unionByName(rows)
    valid = [F.max(F.when(F.col("__row.valid_from") <= F.lit(d), F.col("__row"))).alias(f"__v{i}") for i, d in enumerate(dates)]
    found = both.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("__born").alias("__born"), *valid)
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("as_of"), F.col(f"__v{i}").alias("row")) for i, d in enumerate(dates)]))
    return (found.select(key, "__born", each.alias("e")).where(F.col("__born") <= F.col("e.as_of"))
            .select((unpacked(F.col(key)).alias(key) if text else F.col(key)), "e.as_of", "e.row.valid_from", *[F.col(f"e.row.{c}").alias(c) for c in payload]))


def vault_as_of(vault: dict[str, DataFrame], date: str) -> dict[str, DataFrame]:
    """The tables of a vault as they were after the loads up to ``date``.

    Hubs, links, readings and rejects: the rows loaded by then.  Satellites of
    masters: per parent (and format) the row valid then.
    """
    out = {}
    for name, df in vault.items():
        upto = df.where(F.col(LOAD_DATE) <= F.lit(date)) if LOAD_DATE in df.columns else df
        if name in SATELLITES:
            parent, key, child = SATELLITES[name]
            keys = [key, *[c for c in child if c in df.columns]]
            payload = [c for c in df.columns if c not in keys]
            best = F.max(F.struct(F.col(LOAD_DATE).alias("__date"), *[F.col(c) for c in payload]))
            upto = upto.groupBy(*keys).agg(best.alias("__row")).select(
                *[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])
        out[name] = upto
    return out


class EffectivitySat:
    """A satellite with validity intervals, stored below ``root``.

    ``keys`` identify a parent (and, where a parent has several rows at a time,
    which of them); all other columns but the load date are its content.
    """

    def __init__(self, root: str, keys: Sequence[str]):
        self.root, self.keys = root.rstrip("/"), list(keys)

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        return SV.read_versions(spark, self.root) if path_exists(spark, f"{self.root}/_manifest") else None

    def _last(self, rows: DataFrame) -> DataFrame:
        """Of each parent the rows of its last version."""
        newest = F.max("version").over(Window.partitionBy(*self.keys))
        return rows.withColumn("__newest", newest).where("version = __newest").drop("__newest", "version")

    def table(self, spark: SparkSession) -> DataFrame:
        """sat_hash_key, keys, content, load_date and valid_to of every interval."""
        stored = self._stored(spark)
        if stored is None:
            raise FileNotFoundError(f"nothing loaded into {self.root}")
        rows = self._last(stored) if len(SV.live_versions(spark, self.root)) > 1 else stored.drop("version")
        return rows.drop("__content")

    def valid_at(self, spark: SparkSession, date: str) -> DataFrame:
        """The rows valid at ``date``: a filter, as the intervals of a parent do not overlap."""
        return self.table(spark).where((F.col(LOAD_DATE) <= F.lit(date)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(date))))

    def compact(self, spark: SparkSession) -> None:
        """Publish the whole table as one version, so that reading it needs no shuffle."""
        SV.publish(spark, self._last(self._stored(spark)), self.root, "overwrite", operation="COMPACT")

    def _one_per_date(self, rows: DataFrame) -> DataFrame:
        """One row per parent and load date, the greatest by content digest; combined in the map tasks."""
        own = [*self.keys, LOAD_DATE]
        rest = [c for c in rows.columns if c not in own]
        best = F.max(F.struct("__content", *[c for c in rest if c != "__content"]))
        return rows.groupBy(*own).agg(best.alias("__row")).select(*own, *[F.col(f"__row.{c}").alias(c) for c in rest])

    def load(self, batch: DataFrame) -> int:
        """Merge a batch (keys, content, load_date); returns the rows published (0: no version)."""
        spark = batch.sparkSession
        content = [c for c in batch.columns if c not in (*self.keys, LOAD_DATE)]
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*self.keys, LOAD_DATE]])
        fresh = self._one_per_date(with_change_hash(batch.where(known), content, "__content"))
        path = scratch_dir(spark, "sat-batch")
        fresh.write.parquet(path)
        fresh = spark.read.schema(fresh.schema).parquet(path)
        stored = self._stored(spark)
        merged = fresh.withColumns({"__old": F.lit(False), "__until": F.lit(None).cast(fresh.schema[LOAD_DATE].dataType)})
        if stored is not None:
            touched = fresh.select(*self.keys).distinct()
            if byte_bound(touched, fresh.select(*self.keys)) <= max_broadcast_bytes(spark):
                touched = F.broadcast(touched)  # the stored table is scanned; only rows of touched parents move
            old = self._last(stored.join(touched, self.keys, "left_semi"))
            merged = merged.unionByName(old.select(*fresh.columns, F.lit(True).alias("__old"), F.col("valid_to").alias("__until")))
        # A stored and a new row of one date: both are kept apart until the winner is known.
        date = Window.partitionBy(*self.keys).orderBy(LOAD_DATE, F.col("__content"), F.col("__old"))
        after = date.rowsBetween(1, Window.unboundedFollowing)
        merged = merged.withColumns({"__beaten": F.coalesce(F.lead(LOAD_DATE).over(date) == F.col(LOAD_DATE), F.lit(False))})
        merged = merged.withColumn("__before", F.last(F.when(~F.col("__beaten"), F.col("__content")), ignorenulls=True).over(date.rowsBetween(Window.unboundedPreceding, -1)))
        merged = merged.withColumn("__kept", ~F.col("__beaten") & ~F.col("__content").eqNullSafe(F.col("__before")))
        merged = merged.withColumn("valid_to", F.first(F.when(F.col("__kept"), F.col(LOAD_DATE)), ignorenulls=True).over(after))
        moved = F.when(F.col("__old"), ~F.col("__kept") | ~F.col("valid_to").eqNullSafe(F.col("__until"))).otherwise(F.col("__kept"))
        merged = merged.withColumn("__moved", F.max(moved).over(Window.partitionBy(*self.keys)))
        key = stored_key(md5_key(*[F.col(k).cast("string") for k in self.keys], F.col(LOAD_DATE).cast("string"), F.col("__content")))
        changed = merged.where("__moved and __kept").select(key.alias("sat_hash_key"), *self.keys, *content, LOAD_DATE, "valid_to", "__content")
        path = scratch_dir(spark, "sat-changes")
        changed.write.parquet(path)
        changed = spark.read.schema(changed.schema).parquet(path)
        if changed.isEmpty():
            return 0
        version = SV.publish(spark, changed, self.root, "append", operation="LOAD")
        return SV.history(spark, self.root).where(F.col("version") == version).first()["num_added_rows"]
