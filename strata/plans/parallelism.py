"""Input parallelism guard.

A Parquet file is split by row groups; a small table written as one file with
one row group is read by a single task, and every narrow step after the scan
(hashing, partial aggregation) then runs on one core.  A table that is one
file of bounded size is therefore spread round-robin right after the scan.
Anything larger, or of more than one file, is left as it is scanned: no
shuffle of raw rows is added where it would cost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: The largest single file that is spread.
MAX_BYTES = 256 << 20


def ensure_parallelism(df: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``df`` itself, or ``df`` spread over the cores when it is a scan of one file of at most ``max_bytes``."""
    files = df.inputFiles()
    if len(files) != 1:
        return df
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(files[0])
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return df.repartition(spark.sparkContext.defaultParallelism) if size <= max_bytes else df
