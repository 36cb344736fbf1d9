"""Incremental vault loads and schema drift.

A load batch adds to stored vault tables instead of replacing them:

* hub / link: only keys not stored yet (``left_anti`` on the hash key);
* satellite of readings: a row only when its change hash is new *for its
  parent* (the hash alone collides across links by design).  Of equal
  readings in one batch the earliest by timestamp is kept;
* satellites of masters: a row only when its attributes are new for its parent;
* rejects: a record only when it is new for its target table.

So how the rows are cut into batches decides no row's presence; only the
timestamp and load date of a repeated reading are those of the first batch
that brought it.

A batch is first written to the shared folder, so it is decoded, hashed and
deduplicated once however often its keys are needed; that copy goes when the
load is stored.  Digests travel as their 16 bytes, not as 32 characters.  The
stored table grows with every load; a batch is usually far smaller.  When the
batch's distinct keys are few (measured bytes, at most ``KEYS_BYTES``), they
are broadcast and the stored table is only *scanned* — its key columns, pruned
at the Parquet reader — to find which batch keys already exist; no stored row
is shuffled.  The anti join then runs against that small result.  Of a larger
batch and of the stored keys only 64-bit hashes are shuffled: a row whose hash
is not stored is new.  The others, all rows of a batch that is played again and
a handful otherwise, are then compared by their whole keys.  Where the stored
table has at most twice as many rows as a large batch, as when all of it comes
again, the batch is not copied: one anti join on the whole keys decides.  A load
can be re-run after a failure: rows already stored are found and skipped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.keys import packed, unpacked, with_change_hash
from strata.plans.joins import bound_of, byte_bound, is_unique, max_broadcast_bytes, measured
from strata.session import scratch_dir
from strata.sinks.tables import write_parquet
from strata.sources.files import path_exists, remove_tree

#: Batch keys up to this size are broadcast; they pass through the driver, once or twice per load and table.
KEYS_BYTES = 8 << 20
#: Bytes of a key at least, and how many times as many rows the stored table may have as a batch that is joined with it at once.
LEAST_KEY_BYTES, STORE_SHARE = 8, 2
#: Digests as text are half as long with an entropy coder; the codecs without one leave them as they are.
CODEC = "zstd"
#: Columns that say when a row was loaded, not what it holds.
AUDIT_COLUMNS = ("load_date", "record_source", "ingest_source")


def read_stored(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


def _staged(batch: DataFrame, into: str | None = None) -> DataFrame:
    """The batch written to the shared folder (below ``into``, if given) and read back."""
    path = scratch_dir(batch.sparkSession, "batch") if into is None else f"{into}/{uuid.uuid4().hex[:12]}"
    batch.write.option("compression", CODEC).parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


def _digests(rows: DataFrame, keys: list[str]) -> list[str]:
    """The text columns that hold digests, or may."""
    return [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)
            and (f.name in keys or f.name.endswith(("_key", "_hash")))]


def _holds_the_store(source: DataFrame | None, stored: DataFrame, keys: list[str], most: int) -> bool:
    """Whether a batch made of ``source``'s rows is large and about as large as what is stored, so that one plain join is least work."""
    if source is None:
        return False
    rows = measured(source)[0]
    return rows * LEAST_KEY_BYTES * len(keys) > most and stored.count() <= STORE_SHARE * rows


def _unseen(rows: DataFrame, stored: DataFrame, keys: list[str], into: str | None = None, source: DataFrame | None = None) -> DataFrame:
    """``rows``, one per ``keys``, whose ``keys`` do not occur in ``stored``; those with a NULL key stay.

    ``source`` is a cheap plan with about as many rows, if there is one.
    """
    spark, texts = rows.sparkSession, _digests(rows, keys)
    columns = [(unpacked(F.col(c)).alias(c) if c in texts else F.col(c)) for c in rows.columns]
    rows = rows.withColumns({c: packed(F.col(c)) for c in texts})
    known = stored.select(*[(packed(F.col(c)) if c in texts else F.col(c)).alias(c) for c in keys])
    most = min(KEYS_BYTES, max_broadcast_bytes(spark))
    if _holds_the_store(source, stored, keys, most):
        return rows.join(known, keys, "left_anti").select(*columns)
    rows = _staged(rows, into)
    batch_keys = rows.select(*keys)
    if byte_bound(batch_keys) <= most:
        # Scan the stored keys against the broadcast batch keys: no stored row moves.
        seen = known.join(F.broadcast(batch_keys.distinct()), keys, "left_semi").distinct()
        return rows.join(F.broadcast(seen), keys, "left_anti").select(*columns)
    hashed = F.xxhash64(*keys).alias("__hash")
    hits = _staged(batch_keys.select(hashed).join(known.select(hashed), "__hash", "left_semi"), into)
    if byte_bound(hits) > most:
        return rows.join(known, keys, "left_anti").select(*columns)
    hits, rows = F.broadcast(hits.distinct()), rows.withColumn("__hash", hashed)
    doubted = rows.join(hits, "__hash", "left_semi").join(known.withColumn("__hash", hashed).join(hits, "__hash", "left_semi").select(*keys), keys, "left_anti")
    return rows.join(hits, "__hash", "left_anti").unionByName(doubted).select(*columns)


def _first_of_each(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the least by ``order`` (NULL last), and by the other columns where that ties.

    A batch that is known to have one row per key is left as it is.
    """
    if is_unique(batch, keys):
        return batch
    rest = [c for c in batch.columns if c not in keys]
    rank = [x for c in [*order, *[c for c in rest if c not in order]] for x in (F.col(c).isNull(), F.col(c))]
    best = F.min_by(F.struct(*rest), F.struct(*rank)) if rest else F.lit(None)
    out = batch.groupBy(*keys).agg(best.alias("_row"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in batch.columns])


def new_keys(batch: DataFrame, stored: DataFrame | None, key: str, into: str | None = None) -> DataFrame:
    """Batch rows whose key is not stored yet; one row per new key."""
    fresh = batch if is_unique(batch, [key]) else batch.dropDuplicates([key])
    return fresh if stored is None else _unseen(fresh, stored, [key], into, bound_of(batch))


def new_sat_rows(batch: DataFrame, stored: DataFrame | None, parent_key: str,
                 hash_col: str = "source_hash", order: str = "ingest_timestamp", into: str | None = None) -> DataFrame:
    """Batch rows whose (parent, change hash) is not stored yet; of equal readings the earliest."""
    keys = [parent_key, hash_col]
    rows = _first_of_each(batch, keys, [order] if order in batch.columns else [])
    return rows if stored is None else _unseen(rows, stored, keys, into, bound_of(batch))


def new_content_rows(batch: DataFrame, stored: DataFrame | None, into: str | None = None) -> DataFrame:
    """Batch rows whose content, audit columns aside, is not stored yet; one row per content."""
    content = [c for c in batch.columns if c not in AUDIT_COLUMNS]

    rows = with_change_hash(batch, content, "_content_hash").dropDuplicates(["_content_hash"])
    if stored is not None:
        rows = _unseen(rows, with_change_hash(stored, content, "_content_hash").select("_content_hash"), ["_content_hash"], into)
    return rows.drop("_content_hash")


def new_rejects(batch: DataFrame, stored: DataFrame | None, into: str | None = None) -> DataFrame:
    """Rejected records that are not stored yet; equal ones are combined in the map tasks, as they are texts only."""
    rows = with_change_hash(batch.distinct(), batch.columns, "_content_hash")
    if stored is not None:
        rows = _unseen(rows, with_change_hash(stored, batch.columns, "_content_hash").select("_content_hash"), ["_content_hash"], into)
    return rows.drop("_content_hash")


#: How each vault table takes a batch: (batch, stored or None, folder for copies) -> rows to append.
FRESH: dict[str, Callable[..., DataFrame]] = {
    "hub_survey": lambda b, s, into=None: new_keys(b, s, "hub_survey_key", into),
    "hub_well": lambda b, s, into=None: new_keys(b, s, "hub_well_key", into),
    "link_survey_well": lambda b, s, into=None: new_keys(b, s, "link_survey_well_key", into),
    "sat_seismic_data": lambda b, s, into=None: new_sat_rows(b, s, "link_survey_well_key", into=into),
    "sat_survey_details": new_content_rows,
    "sat_well_details": new_content_rows,
    "rejects": new_rejects,
}


@dataclass
class IncrementalVault:
    """Paths of an incrementally loaded vault."""
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def load(self, spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, int]:
        """Append one batch of freshly built vault tables; rows added per table.

        A table this vault does not know raises before anything is written.
        The new rows of a table are written before later batches see them, so
        a failed batch can be re-run.
        """
        unknown = sorted(set(tables) - set(FRESH))
        if unknown:
            raise ValueError(f"no incremental rule for {unknown}")
        added = {}
        for name, df in tables.items():
            copies = scratch_dir(spark, "load")
            fresh = FRESH[name](df, read_stored(spark, self.path(name)), copies)
            added[name] = write_parquet(fresh, self.path(name), mode="append")
            remove_tree(spark, copies)  # the rows are stored
        return added

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))


# ---- schema drift ------------------------------------------------------------------

DRIFT_SCHEMA = "column_name string, change string, stored_type string, incoming_type string"


def schema_drift(spark: SparkSession, stored: T.StructType, incoming: T.StructType) -> DataFrame:
    """Columns added, removed or retyped between a stored and an incoming schema."""
    s = {f.name: f.dataType.simpleString() for f in stored.fields}
    i = {f.name: f.dataType.simpleString() for f in incoming.fields}
    rows = [(c, "added", None, i[c]) for c in i if c not in s]
    rows += [(c, "removed", s[c], None) for c in s if c not in i]
    rows += [(c, "type_changed", s[c], i[c]) for c in s if c in i and s[c] != i[c]]
    return spark.createDataFrame(rows, DRIFT_SCHEMA)


def drift_profile(spark: SparkSession, stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The drift report with the non-NULL value count of each drifted column on both sides.

    One aggregate job per side; a column a side lacks has a NULL count there.
    """
    report = schema_drift(spark, stored.schema, incoming.schema)
    cols = [r["column_name"] for r in report.select("column_name").collect()]

    def counts(df: DataFrame, side: str) -> DataFrame:
        present = [c for c in cols if c in df.columns]
        if not present:
            return spark.createDataFrame([], f"column_name string, {side} bigint")
        agg = df.agg(*[F.count(F.col(c)).alias(c) for c in present])
        stack = ", ".join(f"'{c}', `{c}`" for c in present)
        return agg.selectExpr(f"stack({len(present)}, {stack}) as (column_name, {side})")

    return (report.join(counts(stored, "stored_non_null"), "column_name", "left")
                  .join(counts(incoming, "incoming_non_null"), "column_name", "left"))


def align_to(df: DataFrame, target: T.StructType, allow_new: bool = True) -> DataFrame:
    """Shape ``df`` like ``target``: missing columns as NULL, types cast, new ones kept at the end."""
    cols = []
    for f in target.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if allow_new:
        cols += [F.col(c) for c in df.columns if c not in target.fieldNames()]
    return df.select(*cols)
