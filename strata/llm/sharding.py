"""Sharding by fixed virtual slots (operator 7, DataFrame only).

A record's key is hashed into one of thousands of slots, for good.  A small
versioned map says which shard holds each slot; rebalancing edits the map and
moves whole slots.  ``balance`` keeps as many slots as fit the mean load where
they are and hands the released ones, largest first, to the lightest shard;
``grow`` adds a shard and moves slots only into it.

Defined results: a NULL key hashes like an empty one; a NULL text has no bytes
(size 1, checksum 0); repeated rows are counted and placed as often as they
occur; an empty table gives an empty assignment over an even map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

N_SLOTS = 4096
#: Sub-bins of a slot; positions inside a shard are counted per bin, so no task sorts a whole shard.
SUB_BINS = 16
#: Equal rows that one task numbers at a time.
COPIES = 256


def slot_of(key: Column, n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(n_slots)).cast("int")


def numbered(records: DataFrame) -> DataFrame:
    """``records`` plus ``copy``, which numbers equal rows from 0, whatever the partitions.

    Equal rows are counted and made again; a row that fills a third of the
    table leaves its task as blocks of ``COPIES`` and is made in many.
    """
    own = records.columns
    blocks = records.groupBy(*own).count().select(
        *own, "count", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("count") - 1, F.lit(COPIES).cast("bigint"))).alias("start"))
    last = F.least(F.col("start") + COPIES, F.col("count")) - 1
    return blocks.repartition(*own, "start").select(*own, F.explode(F.sequence("start", last)).alias("copy"))


def slot_bytes(records: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """(vslot, bytes) for every slot, empty ones included; ``n_slots`` rows whatever the input."""
    sums = records.groupBy("vslot").agg(F.sum("size").alias("bytes"))
    slots = records.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("vslot"))
    return slots.join(sums, "vslot", "left").select("vslot", F.coalesce("bytes", F.lit(0)).alias("bytes"))


def even_map(spark: SparkSession, n_shards: int, n_slots: int = N_SLOTS) -> DataFrame:
    return spark.range(n_slots).select(F.col("id").cast("int").alias("vslot"),
                                       (F.col("id") % n_shards).cast("int").alias("shard"))


def _hand_out(placed: DataFrame, n_shards: int) -> DataFrame:
    """Give every slot with ``shard`` NULL to the shard that is lightest at that moment, largest slot first.

    One row holds all slots (their number is a parameter, not the data's), and
    a fold over the sorted slots carries the shard loads.
    """
    loads = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: F.aggregate(
        F.filter("slots", lambda x: x["shard"] == s), F.lit(0).cast("bigint"), lambda acc, x: acc + x["bytes"]))
    free = F.transform(F.array_sort(F.transform(F.filter("slots", lambda x: x["shard"].isNull()),
                                                lambda x: F.struct((-x["bytes"]).alias("neg"), x["vslot"].alias("vslot")))),
                       lambda x: x)
    start = F.struct(F.col("loads").alias("loads"),
                     F.array().cast("array<struct<vslot:int,shard:int>>").alias("done"))

    def step(acc, x):
        lightest = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return F.struct(
            F.transform(acc["loads"], lambda v, i: F.when(i == lightest, v - x["neg"]).otherwise(v)).alias("loads"),
            F.concat(acc["done"], F.array(F.struct(x["vslot"].alias("vslot"), lightest.alias("shard")))).alias("done"))

    one = placed.agg(F.collect_list(F.struct("vslot", "shard", "bytes")).alias("slots")).withColumn("loads", loads)
    moved = one.select(F.explode(F.aggregate(free, start, step)["done"]).alias("m")).select("m.vslot", "m.shard")
    return placed.filter("shard is not null").select("vslot", "shard").unionByName(moved)


def balance(slot_map: DataFrame, load: DataFrame, n_shards: int) -> DataFrame:
    """Edit the map so that shard bytes come out near equal, moving as few slots as that takes."""
    both = slot_map.join(load, "vslot")
    by_shard = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot").rowsBetween(Window.unboundedPreceding, 0)
    mean = F.sum("bytes").over(Window.partitionBy()) / F.lit(n_shards)
    kept = both.withColumns({"upto": F.sum("bytes").over(by_shard), "mean": mean}).select(
        "vslot", "bytes", F.when(F.col("upto") <= F.col("mean"), F.col("shard")).alias("shard"))
    return _hand_out(kept, n_shards)


def grow(slot_map: DataFrame, load: DataFrame, n_shards: int) -> DataFrame:
    """The map with shard ``n_shards`` added: every old shard gives up its share of slots, only to the new one."""
    both = slot_map.join(load, "vslot")
    by_shard = Window.partitionBy("shard").orderBy("bytes", "vslot").rowsBetween(Window.unboundedPreceding, 0)
    gives = F.sum("bytes").over(Window.partitionBy("shard")) / F.lit(n_shards + 1)
    return both.withColumns({"upto": F.sum("bytes").over(by_shard), "gives": gives}).select(
        "vslot", F.when((F.col("upto") <= F.col("gives")) & (F.col("bytes") > 0), F.lit(n_shards))
        .otherwise(F.col("shard")).cast("int").alias("shard"))


def store_map(slot_map: DataFrame, path: str, version: int) -> DataFrame:
    """Write one version of the map (one small file) and read it back."""
    out = f"{path.rstrip('/')}/version={version}"
    slot_map.coalesce(1).write.mode("overwrite").parquet(out)
    return read_map(slot_map.sparkSession, path, version)


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("vslot int, shard int").parquet(f"{path.rstrip('/')}/version={version}")


def assign(records: DataFrame, slot_map: DataFrame, order: list[str]) -> DataFrame:
    """``records`` (with vslot) plus shard and slot, the record's place in its shard, without gaps from 0.

    Places are counted per bin (slot and sub-bin); a running sum over the
    ``n_slots * SUB_BINS`` bin counts gives each bin its offset.  That table's
    size and the map's are fixed by parameters, which is the bound of the
    broadcast.
    """
    binned = records.withColumn("sub", F.pmod(F.xxhash64(F.lit("sub"), *[F.col(c) for c in order]), F.lit(SUB_BINS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("vslot", "sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (binned.groupBy("vslot", "sub").count().join(F.broadcast(slot_map), "vslot")
               .withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0)))
               .select("vslot", "sub", "shard", "first"))
    in_bin = Window.partitionBy("vslot", "sub").orderBy(*order)
    return (binned.withColumn("nth", F.row_number().over(in_bin) - 1)
            .join(F.broadcast(offsets), ["vslot", "sub"])
            .withColumn("slot", (F.col("first") + F.col("nth")).cast("bigint")).drop("sub", "nth", "first"))
