"""A file stream whose columns may change while it runs.

A file stream needs its columns declared, and drops what a later file adds.
Here the stream carries only the names of arriving Parquet files.  Each
micro-batch reads their footers in tasks, widens the stored schema where they ask
for it, and stores the batch's rows under the schema that holds then:

* a new column is kept: earlier rows have NULL there; a column that a file lacks is
  NULL in its rows;
* a numeric column takes the widest type seen (integers by width, ``double``
  once a file stores it as a floating number); a narrower file is cast;
* a column whose types no single type holds stops the stream with an error, before
  a row of that batch is stored.

The registry has one small table per schema version; the rows lie in
``version=V/batch=B`` folders.  A batch that is run again finds its version registered
and replaces its own folder, so each file counts once.  Reading declares each version's
columns, so no stored footer is read for them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.operators.incremental import align_to, schema_drift
from strata.session import scratch_dir
from strata.sources.files import path_exists
from strata.sources.readings import file_columns, widest

# Fixed columns of Spark's binary file source.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
REGISTRY_SCHEMA = "version int, place int, name string, type string"


def versions(spark: SparkSession, root: str) -> dict[int, T.StructType]:
    """The registered schemas by version."""
    path = f"{root.rstrip('/')}/registry"
    if not path_exists(spark, path):
        return {}
    rows = spark.read.schema(REGISTRY_SCHEMA).parquet(path).orderBy("version", "place").collect()
    return {v: _struct([(r["name"], r["type"]) for r in rows if r["version"] == v]) for v in sorted({r["version"] for r in rows})}


def _struct(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in columns))


def merged(schemas: list[T.StructType]) -> T.StructType:
    """All columns in order of first appearance, each in the widest of its types."""
    types: dict[str, set[str]] = {}
    for s in schemas:
        for f in s.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    return _struct([(name, widest(found)) for name, found in types.items()])


def _register(spark: SparkSession, root: str, schema: T.StructType) -> tuple[int, T.StructType]:
    """The version that holds ``schema`` besides all earlier ones; a new one where the last does not."""
    known = versions(spark, root)
    last = max(known, default=-1)
    whole = merged([*([known[last]] if known else []), schema])
    if known and whole.simpleString() == known[last].simpleString():
        return last, whole
    rows = [(last + 1, i, f.name, f.dataType.simpleString()) for i, f in enumerate(whole.fields)]
    spark.createDataFrame(rows, REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/registry")
    return last + 1, whole


def store_files(files: DataFrame, root: str, batch_id: int) -> None:
    """Add the rows of Parquet ``files`` (path) to the table below ``root`` as one batch."""
    spark = files.sparkSession
    staged = scratch_dir(spark, "drift-names")
    file_columns(files).write.parquet(staged)
    # One row per column of each file of the batch, which maxFilesPerTrigger bounds.
    found: dict[str, list[tuple[str, str]]] = {}
    for r in spark.read.parquet(staged).orderBy("path", "place").collect():
        found.setdefault(r["path"], []).append((r["name"], r["type"]))
    alike: dict[tuple, list[str]] = {}
    for path, columns in found.items():
        alike.setdefault(tuple(columns), []).append(path)
    if not alike:
        return
    version, schema = _register(spark, root, merged([_struct(list(columns)) for columns in alike]))
    parts = [align_to(spark.read.schema(_struct(list(columns))).parquet(*paths), schema) for columns, paths in alike.items()]
    reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(f"{root.rstrip('/')}/rows/version={version}/batch={batch_id}")


def load_drifting(spark: SparkSession, inbox: str, root: str, checkpoint: str, max_files: int = 1000) -> None:
    """Store every Parquet file not yet seen below ``inbox``, whatever its columns."""
    names = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files).load(inbox).select("path"))   # names alone: contents are not read
    (names.writeStream.foreachBatch(lambda batch, batch_id: store_files(batch, root, batch_id))
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def read(spark: SparkSession, root: str) -> DataFrame:
    """All stored rows under the last schema."""
    known = versions(spark, root)
    if not known:
        raise ValueError(f"no batch was stored below {root}")
    last = known[max(known)]
    folders = {v: f"{root.rstrip('/')}/rows/version={v}" for v in known}
    parts = [align_to(spark.read.schema(s).parquet(f"{folders[v]}/batch=*"), last) for v, s in known.items() if path_exists(spark, folders[v])]
    return reduce(DataFrame.unionByName, parts)


def drift_events(spark: SparkSession, root: str) -> list[tuple[int, str, str, str | None, str | None]]:
    """(version, column, change, earlier type, later type) of every change after the first schema."""
    known = versions(spark, root)
    return [(v, *map(r.__getitem__, ("column_name", "change", "stored_type", "incoming_type")))
            for v in list(known)[1:] for r in schema_drift(spark, known[v - 1], known[v]).collect()]
