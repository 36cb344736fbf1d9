"""Reading tables: the multi-file scan of decoded/salvaged files and its checks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUIRED_COLUMNS = ("survey_id", "well_id", "depth", "amplitude", "quality_flag")
RECONSTRUCTED_GLOB = "*_reconstructed.parquet"


class NoInputError(RuntimeError):
    """No reading files were found under the data folder."""


class MissingColumnsError(RuntimeError):
    """Reading files lack columns the vault needs."""


def require_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """``df`` itself if its schema covers ``required``; otherwise an error, before any job runs."""
    lacking = set(required).difference(df.columns)
    if lacking:
        raise MissingColumnsError(f"a readings table needs {sorted(lacking)} as well; its schema is "
                                  f"{df.schema.simpleString()}")
    return df


def clean_readings(df: DataFrame) -> DataFrame:
    """Floating NaN becomes NULL so counts and means skip it, as pandas does."""
    out = df
    for name in ("depth", "amplitude"):
        if name in df.columns:
            out = out.withColumn(name, F.nanvl(F.col(name).cast("double"),
                                               F.lit(None).cast("double")))
    return out


# Numeric types from narrow to wide: Parquet files store a value in one, Spark reads it in any wider one.
_WIDER = ("tinyint", "smallint", "int", "bigint"), ("float", "double")


def widest(types: set[str]) -> str:
    """The type that holds all ``types`` of one column: the widest integer, or ``double`` once one is floating."""
    if len(types) == 1:
        return next(iter(types))
    whole, real = _WIDER
    if types <= set(whole):
        return max(types, key=whole.index)
    if types <= {*whole, *real}:
        return "double"
    raise MissingColumnsError(f"one column is stored as {sorted(types)}, which no single type holds")


def widened_schema(spark: SparkSession, data_dir: str, glob: str) -> T.StructType:
    """The union of all files' columns, each in the widest type any file stores it in.

    Footers are read by tasks; only the distinct (column, type) pairs come back.
    """
    from strata.sources.files import list_tree

    found = (file_columns(list_tree(spark, data_dir, glob, skip_hidden=True).select("path").repartition("path"))
             .groupBy("name").agg(F.min("place").alias("place"), F.collect_set("type").alias("types"))
             .orderBy("place", "name").collect())
    return T.StructType.fromDDL(", ".join(f"`{r['name']}` {widest(set(r['types']))}" for r in found))


def file_columns(files: DataFrame) -> DataFrame:
    """(path, place, name, type): the columns in the footers of Parquet files, read by tasks."""
    from pyspark.sql.pandas.types import from_arrow_type

    from strata.session import ship_package
    from strata.sources.fsys import resolve

    ship_package(files.sparkSession)

    def footers(batches):
        import pandas as pd
        import pyarrow.parquet as pq

        for pdf in batches:
            out = []
            for path in pdf["path"]:
                fs, p = resolve(path)
                with fs.open_input_file(p) as f:
                    out += [(path, i, c.name, from_arrow_type(c.type, prefer_timestamp_ntz=True).simpleString())
                            for i, c in enumerate(pq.read_schema(f))]
            yield pd.DataFrame(out, columns=["path", "place", "name", "type"])

    return files.select("path").mapInPandas(footers, "path string, place int, name string, type string")


def scan_reconstructed(spark: SparkSession, data_dir: str,
                       glob: str = RECONSTRUCTED_GLOB,
                       required=REQUIRED_COLUMNS, schema=None) -> DataFrame:
    """All ``*_reconstructed.parquet`` files below ``data_dir``, unioned by name.

    One Parquet scan with ``mergeSchema``: a file lacking a column contributes
    NULLs, a file with an extra column adds it.  Where files store one column
    in different numeric widths, the scan reads all of them in the widest.
    ``source_file`` keeps lineage.  Schema merging reads every file footer (a
    distributed job); pass ``schema`` to declare the columns instead, e.g. for
    a very large lake.  Raises :class:`NoInputError` when nothing matches and
    :class:`MissingColumnsError` when a required column is missing everywhere.
    """
    from strata.sources.files import any_file

    if not any_file(spark, data_dir, glob, recursive=True):
        raise NoInputError(f"No reconstructed parquet files found under {data_dir}")

    def reader():
        return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)

    try:
        df = (reader().schema(schema) if schema is not None else reader().option("mergeSchema", "true")).parquet(data_dir)
    except Exception as exc:
        if "MERGE_SCHEMA" in str(exc):
            df = reader().schema(widened_schema(spark, data_dir, glob)).parquet(data_dir)
        elif isinstance(exc, AnalysisException):  # only hidden or in-progress files matched
            raise NoInputError(f"No readable reconstructed parquet files under {data_dir}") from exc
        else:
            raise
    require_columns(df, required)
    df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return clean_readings(df)
