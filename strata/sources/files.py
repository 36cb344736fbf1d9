"""File listing and optional sources.

Trees are listed by tasks (``pyarrow.fs``); existence checks go through
Hadoop's FileSystem.  Neither names nor contents are gathered on the driver.
"""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.fsys import resolve, with_root


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files, if it is there."""
    fs, hpath = _fs_and_path(spark, path)
    fs.delete(hpath, True)


def any_file(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> bool:
    """True as soon as one matching (non-hidden) file is found below ``root``.

    Walks Hadoop's lazy file iterator and stops at the first match, so a
    non-empty lake is not listed in full just to learn that it is non-empty.
    """
    fs, hpath = _fs_and_path(spark, root)
    if not fs.exists(hpath):
        return False
    it = fs.listFiles(hpath, recursive)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if not name.startswith((".", "_")) and fnmatch.fnmatchcase(name, glob):
            return True
    return False


def list_tree(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True,
              skip_hidden: bool = False) -> DataFrame:
    """(path, length) of the files under ``root`` whose base name matches ``glob`` (case-sensitive).

    Folders are listed by tasks, one level of the tree per job, and each
    level's listing is written to the shared folder, so no listing passes
    through the driver.  Every name counts, hidden ones too, unless
    ``skip_hidden``; zero-length files are kept.  A root that does not exist
    raises ``FileNotFoundError``; a single file is its own listing.
    """
    import pyarrow.fs as pafs

    from strata.session import scratch_dir, ship_package

    ship_package(spark)
    fs, base = resolve(root)
    kind = fs.get_file_info(base).type
    if kind == pafs.FileType.NotFound:
        raise FileNotFoundError(f"no such file or folder: {root}")

    def listing(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for folder in pdf["path"]:
                own, path = resolve(folder)
                found = own.get_file_info(path)
                entries = [found] if found.type == pafs.FileType.File else own.get_file_info(
                    pafs.FileSelector(path, recursive=False))
                for e in entries:
                    if skip_hidden and e.base_name.startswith((".", "_")):
                        continue
                    out.append((with_root(root, e.path), e.size, e.type == pafs.FileType.Directory))
            yield pd.DataFrame(out, columns=["path", "length", "folder"])

    level = spark.createDataFrame([(with_root(root, base.rstrip("/") or "/"),)], "path string")
    tree = scratch_dir(spark, "listing")
    schema = "path string, length bigint, folder boolean"
    depth = 0
    while True:
        out = f"{tree}/level={depth}"
        level.mapInPandas(listing, schema).write.parquet(out)
        listed = spark.read.schema(schema).parquet(out)
        level = listed.where("folder").select("path").repartition("path")
        depth += 1
        if not recursive or level.isEmpty():
            break
    pattern = fnmatch.translate(glob).replace("(?s:", "(?s)").removesuffix(r")\Z").removesuffix(r")\z")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return (spark.read.schema(schema).option("basePath", tree).parquet(tree)
            .where(~F.col("folder") & F.rlike(name, F.lit(f"^(?:{pattern})$")))
            .select("path", F.coalesce("length", F.lit(0)).alias("length")))


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType | str,
                     required: tuple[str, ...] = ()) -> DataFrame:
    """CSV with a header whose columns are found by name and cast to ``schema``.

    A column of the schema that the file lacks is NULL, or an error when it is
    ``required``; columns beyond the schema follow as text.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = spark.read.option("header", True).csv(path)
    lacking = sorted(set(required) - set(raw.columns))
    if lacking:
        raise ValueError(f"{path} has no column {', '.join(lacking)}; its header is {raw.columns}")
    cols = [(F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    return raw.select(*cols, *[c for c in raw.columns if c not in schema.names])


def read_csv_optional(spark: SparkSession, path: str, schema: T.StructType | str,
                      header: bool = True) -> DataFrame:
    """CSV with a declared schema; an absent file gives an empty table of that schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return read_csv(spark, path, schema, header)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, infer: bool = False) -> DataFrame:
    reader = spark.read.option("header", header)
    if schema is not None and header:
        return read_csv_by_name(spark, path, schema)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)
