"""Trace files as a stream: each file that arrives in a lake is decoded once.

Two steps, so that no listing passes through the driver:

* ``announce`` lists the lake in tasks and appends the files it has not named
  yet to an *arrivals log*: a Parquet table of record ranges
  ``(path, start, stop)``.  A huge file is many rows, each file of the log covers about
  ``ENTRY_BYTES`` of trace data: neighbouring paths, which hold neighbouring surveys where
  ``strata.sinks.trace_writer`` made them.
* ``trace_stream`` is a file stream over that log.  Spark's own file source
  keeps the offsets, so a restart goes on behind the last finished batch; a
  trigger takes at most about ``max_bytes`` of trace data.  The scan spreads a batch's log
  files over the cores, and the task that reads one decodes its ranges: nothing is shuffled.

A file is taken once, by its path, as Spark's file source does: writers put whole files
in place (``strata.sinks.trace_writer`` does).  Names that begin with ``.`` or ``_`` are
passed by.  Files that are too short or of another format are announced and yield no
record.  A file that cannot be opened fails its batch, which the next run tries again: a
stream that passed it by would never come back to it.  An ``announce`` that fails on the
way is made good by the next one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.convert import with_survey_block
from strata.session import scratch_dir, ship_package
from strata.sources.files import list_tree, path_exists
from strata.sources.fixedwidth import DEFAULT_GLOB, HEADER_SIZE, RECORD_SCHEMA, RECORD_SIZE, FileRanges, FixedWidthReader
from strata.sources.fsys import resolve
from strata.sources.readings import clean_readings
from strata.streaming.incremental_stream import load_stream

ARRIVAL_SCHEMA = "path string, start bigint, stop bigint"
#: Trace data that one file of the arrivals log covers, and that one trigger takes.
ENTRY_BYTES = 512 << 20
TRIGGER_BYTES = 1 << 40
#: Records of one range, and what opening a file costs beside its bytes.
RANGE_RECORDS = 4_000_000
OPEN_BYTES = 1 << 20


def announce(spark: SparkSession, lake: str, log: str, glob: str = DEFAULT_GLOB,
             entry_bytes: int = ENTRY_BYTES, range_records: int = RANGE_RECORDS) -> int:
    """Add the lake's new files to the arrivals log; the number of ranges added."""
    files = list_tree(spark, lake, glob, skip_hidden=True)
    if path_exists(spark, log):
        known = spark.read.schema(ARRIVAL_SCHEMA).parquet(log).select("path").distinct()
        files = files.join(known, "path", "left_anti")
    n = F.greatest(F.floor((F.col("length") - HEADER_SIZE) / RECORD_SIZE), F.lit(0)).cast("bigint")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(n - 1, F.lit(0)), F.lit(range_records).cast("bigint"))
    ranges = files.select("path", n.alias("n"), F.explode(starts).alias("start"))
    staged = scratch_dir(spark, "arrivals")
    ranges.select("path", "start", F.least(F.col("start") + range_records, "n").alias("stop")).write.parquet(staged)
    ranges = spark.read.schema(ARRIVAL_SCHEMA).parquet(staged)
    added, size = ranges.agg(F.count(F.lit(1)), F.sum((F.col("stop") - F.col("start")) * RECORD_SIZE + OPEN_BYTES)).first()
    if added:
        ranges.repartitionByRange(math.ceil(size / entry_bytes), "path", "start").write.mode("append").parquet(log)
    return added


def trace_stream(spark: SparkSession, lake: str, log: str, max_bytes: int = TRIGGER_BYTES,
                 entry_bytes: int = ENTRY_BYTES) -> DataFrame:
    """The records of announced files as a streaming DataFrame; NaN depth and amplitude are NULL."""
    ship_package(spark)
    per_trigger = max(1, max_bytes // entry_bytes)
    reader = FixedWidthReader({"path": lake, "skipUnreadable": "false"}, None)

    def decode(batches):
        for batch in batches:
            for r in batch.to_pylist():
                yield from reader.read(FileRanges([(resolve(r["path"])[1], r["start"], r["stop"])], lake))

    arrivals = spark.readStream.schema(ARRIVAL_SCHEMA).option("maxFilesPerTrigger", per_trigger).parquet(log)
    return clean_readings(arrivals.mapInArrow(decode, RECORD_SCHEMA))


def _but(name: str, options: dict) -> dict:
    return {k: v for k, v in options.items() if k != name}


def convert_arrivals(spark: SparkSession, lake: str, log: str, out: str, checkpoint: str, glob: str = DEFAULT_GLOB, **sizes) -> int:
    """Decode every file not yet decoded into Parquet below ``out``, by blocks of surveys; the number of ranges announced.

    Spark's file sink makes each batch visible once, also when it is run again.  A folder ``survey_block=`` holds
    ``convert.BLOCK_SURVEYS`` ids: a file per survey and batch would cost more than the readings in it.
    """
    added = announce(spark, lake, log, glob, **_but("max_bytes", sizes))
    if path_exists(spark, log):
        (with_survey_block(trace_stream(spark, lake, log, **_but("range_records", sizes)))
         .writeStream.format("parquet").partitionBy("survey_block")
         .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    return added


def load_arrivals(spark: SparkSession, lake: str, log: str, vault_root: str, checkpoint: str, load_ts: str,
                  glob: str = DEFAULT_GLOB, **sizes) -> dict:
    """Load every file not yet loaded into an incremental vault; rows added per table."""
    announce(spark, lake, log, glob, **_but("max_bytes", sizes))
    if not path_exists(spark, log):
        return {"batches": 0}
    return load_stream(trace_stream(spark, lake, log, **_but("range_records", sizes)), vault_root, checkpoint, load_ts, keep_source_timestamp=False)
