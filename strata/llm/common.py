"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Later jobs then read finished files instead of recomputing the lineage,
    and a lost executor loses nothing.
    """
    ship_package(df.sparkSession)
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(names: list[str]) -> list[Column]:
    """Columns by their literal names, dots and all."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def aside(df: DataFrame, made: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``df`` with columns that would clash with ``made`` renamed, and the columns that give the original ones back."""
    held = {c: f"__held_{c}" for c in df.columns if c.lower() in made}
    back = [c.alias(n) for n, c in zip(df.columns, quoted([held.get(n, n) for n in df.columns]))]
    return df.withColumnsRenamed(held), back


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (a NULL id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(folds)


def shuffle_partitions(spark: SparkSession) -> int:
    """The reduce-side width that the session is configured with for its data size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def add_columns(df: DataFrame, inputs: list[str], fields: str, fn) -> DataFrame:
    """``df`` plus columns computed from ``inputs`` in Arrow batches; all other columns pass through untouched.

    ``fn`` gets one Arrow array per input and returns one Arrow array per field
    of the DDL string ``fields``.  Existing columns of the same names give way.
    """
    ship_package(df.sparkSession)
    new = T.StructType.fromDDL(fields)
    kept = [c for c in df.columns if c not in new.names]
    schema = T.StructType([T.StructField(f.name, f.dataType) for c in kept for f in [df.schema[c]]] + list(new))

    def run(batches):
        for batch in batches:
            made = fn(*[batch.column(c) for c in inputs])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], schema.names)

    return df.mapInArrow(run, schema)
