"""Reading a commit log: history and the active files at a version.

Works on a ``_delta_log`` folder: JSON commits named by their version, and
checkpoint files, which hold the state of a version whose commits may since
have been removed.  Everything is a DataFrame job: actions are exploded into
rows, and the state at version N keeps, per file path, the last action up to N
(``max_by``), so a log with millions of actions never passes through the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATS_SCHEMA = T.StructType([T.StructField("numRecords", T.LongType())])

# The action fields this module reads, declared so that reading a log needs no
# schema-inference pass; fields a log line lacks read as NULL, others are ignored.
LOG_SCHEMA = T.StructType([
    T.StructField("add", T.StructType([
        T.StructField("path", T.StringType()), T.StructField("size", T.LongType()),
        T.StructField("modificationTime", T.LongType()), T.StructField("dataChange", T.BooleanType()),
        T.StructField("stats", T.StringType())])),
    T.StructField("remove", T.StructType([
        T.StructField("path", T.StringType()), T.StructField("size", T.LongType()),
        T.StructField("deletionTimestamp", T.LongType()), T.StructField("dataChange", T.BooleanType())])),
    T.StructField("commitInfo", T.StructType([
        T.StructField("timestamp", T.LongType()), T.StructField("operation", T.StringType()),
        T.StructField("operationParameters", T.StructType([T.StructField("mode", T.StringType())])),
        T.StructField("operationMetrics", T.StructType([
            T.StructField("num_added_rows", T.LongType()), T.StructField("num_added_files", T.LongType()),
            T.StructField("num_removed_files", T.LongType())]))])),
])


class IncompleteLogError(RuntimeError):
    """Commits that the answer needs are gone and no checkpoint stands in for them."""


def log_folder(root: str) -> str:
    return f"{root.rstrip('/')}/_delta_log"


def read_actions(spark: SparkSession, root: str) -> DataFrame:
    """All lines of the JSON commits with their ``version``; files of other names are left out."""
    df = spark.read.schema(LOG_SCHEMA).option("pathGlobFilter", "[0-9]*.json").json(log_folder(root))
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1)
    return df.withColumn("version", number.try_cast("bigint")).where("version is not null")


def checkpoints(spark: SparkSession, root: str) -> DataFrame:
    """The adds that checkpoint files hold, with the checkpoint's ``version``."""
    from strata.sources.files import list_tree

    schema = T.StructType([f for f in LOG_SCHEMA.fields if f.name == "add"])
    if list_tree(spark, log_folder(root), "*.checkpoint*.parquet", recursive=False).isEmpty():
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("version", T.LongType())]))
    df = spark.read.schema(schema).option("pathGlobFilter", "*.checkpoint*.parquet").parquet(log_folder(root))
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.checkpoint", 1)
    return df.withColumn("version", number.try_cast("bigint")).where("version is not null")


def _field(df: DataFrame, path: str, dtype: str) -> F.Column:
    """A nested field, or NULL when no log line ever carried it."""
    head, *rest = path.split(".")
    dt = df.schema[head].dataType if head in df.columns else None
    for part in rest:
        if not isinstance(dt, T.StructType) or part not in dt.fieldNames():
            return F.lit(None).cast(dtype)
        dt = dt[part].dataType
    if dt is None:
        return F.lit(None).cast(dtype)
    return F.col(path).cast(dtype)


def history(spark: SparkSession, root: str) -> DataFrame:
    """One row per commit: version, timestamp, operation, mode and row/file metrics."""
    a = read_actions(spark, root)
    return (a.where(F.col("commitInfo").isNotNull())
            .select("version",
                    _field(a, "commitInfo.timestamp", "bigint").alias("timestamp"),
                    _field(a, "commitInfo.operation", "string").alias("operation"),
                    _field(a, "commitInfo.operationParameters.mode", "string").alias("mode"),
                    _field(a, "commitInfo.operationMetrics.num_added_rows", "bigint").alias("num_added_rows"),
                    _field(a, "commitInfo.operationMetrics.num_added_files", "bigint").alias("num_added_files"),
                    _field(a, "commitInfo.operationMetrics.num_removed_files", "bigint")
                    .alias("num_removed_files")))


def _rows(a: DataFrame, kind: str) -> DataFrame:
    stats = F.from_json(F.col("add.stats"), STATS_SCHEMA)["numRecords"] if kind == "add" else F.lit(None).cast("bigint")
    return a.where(F.col(kind).isNotNull()).select(
        "version", F.lit(kind).alias("kind"), F.col(f"{kind}.path").alias("path"),
        F.col(f"{kind}.size").alias("size"), stats.alias("num_records"))


def file_actions(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """add and remove actions as rows: version, kind, path, size, num_records.

    From the last checkpoint at or before ``version`` (default: any) on; its
    files count as added by it.  A log that lacks its first commits and has no
    such checkpoint raises.
    """
    a, saved = read_actions(spark, root), checkpoints(spark, root)
    upto = F.lit(True) if version is None else F.col("version") <= version
    first = a.agg(F.min("version")).first()[0]
    base = saved.where(upto).agg(F.max("version")).first()[0]
    if base is None:
        if first is not None and first > 0:
            raise IncompleteLogError(f"the log of {root} begins with version {first} and no earlier checkpoint is left")
        return _rows(a.where(upto), "add").unionByName(_rows(a.where(upto), "remove"))
    later = a.where(upto & (F.col("version") > base))
    return (_rows(saved.where(F.col("version") == base), "add")
            .unionByName(_rows(later, "add")).unionByName(_rows(later, "remove")))


def active_files(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Files live at ``version`` (default latest): last action per path is an add."""
    last = file_actions(spark, root, version).groupBy("path").agg(
        F.max_by(F.struct("kind", "size", "num_records", "version"), F.col("version")).alias("s"))
    return (last.where(F.col("s.kind") == "add")
            .select("path", F.col("s.size").alias("size"), F.col("s.num_records").alias("num_records"),
                    F.col("s.version").alias("added_in_version")))


def activity(spark: SparkSession, root: str) -> DataFrame:
    """(version, active_files, active_rows, active_versions) for every commit after the first state.

    One grouped job over all versions: a file counts from the version that
    adds it up to the one that removes it, so each version only needs the
    running sums of what came and went.  ``active_versions`` counts the
    versions that still have a file.
    """
    acts = file_actions(spark, root)
    by_path = Window.partitionBy("path").orderBy("version", F.col("kind").desc())
    lives = (acts.withColumn("gone", F.lead("version").over(by_path)).where("kind = 'add'")
             .select("version", "gone", F.coalesce("num_records", F.lit(0)).alias("n")))
    came = lives.groupBy("version").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"), F.lit(1).alias("versions"))
    went = (lives.where("gone is not null").groupBy(F.col("gone").alias("version"))
            .agg((-F.count(F.lit(1))).alias("files"), (-F.sum("n")).alias("rows"), F.lit(0).alias("versions")))
    ended = (lives.groupBy("version").agg(F.when(F.count("gone") == F.count(F.lit(1)), F.max("gone")).alias("end"))
             .where("end is not null").groupBy(F.col("end").alias("version")).agg((-F.count(F.lit(1))).alias("versions"))
             .select("version", F.lit(0).alias("files"), F.lit(0).alias("rows"), "versions"))
    commits = read_actions(spark, root).select("version").distinct().select("version", *[F.lit(0).alias(c) for c in ("files", "rows", "versions")])
    changes = came.unionByName(went).unionByName(ended).unionByName(commits).groupBy("version").agg(
        *[F.sum(c).alias(c) for c in ("files", "rows", "versions")])
    running = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, 0)  # a row per commit
    return changes.select("version", *[F.sum(c).over(running).cast("bigint").alias(f"active_{c}") for c in ("files", "rows", "versions")])
