"""Vault inputs read from the benchmark tables.

The benchmark ships TPC-H-like tables; this module names their columns the
way the vault expects them:

* readings   <- ``lineitem``: survey = supplier, well = part, depth = quantity,
  amplitude = extended price, quality flag = (return flag 'R'),
  ingest timestamp = ship date;
* survey master <- ``supplier`` left-joined to ``nation`` and ``region``:
  survey type = nation name, source format = region name;
* well master <- ``part``: well name = part name, operator = brand.

Only the columns named here reach the Parquet scans (column pruning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.parallelism import ensure_parallelism
from strata.sources.readings import clean_readings


# Declared schemas of the benchmark tables (a declared schema also spares the
# footer-reading job Spark runs to infer one).
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    df = li.select(
        F.col("l_suppkey").cast("bigint").alias("survey_id"),
        F.col("l_partkey").cast("bigint").alias("well_id"),
        F.col("l_quantity").cast("double").alias("depth"),
        F.col("l_extendedprice").cast("double").alias("amplitude"),
        (F.col("l_returnflag") == "R").cast("bigint").alias("quality_flag"),
        F.col("l_shipdate").alias("ingest_timestamp"),
    )
    return clean_readings(ensure_parallelism(df))


def survey_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation and region are fixed-size (25 and 5 rows): broadcasting them is bounded.
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left")
             .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left")
             .select(F.col("s_suppkey").cast("bigint").alias("survey_type_id"),
                     F.col("n_name").alias("survey_type"),
                     F.col("r_name").alias("source_format")))


def well_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("bigint").alias("well_id"),
        F.col("p_name").alias("well_name"),
        F.lit(None).cast("double").alias("location_lat"),
        F.lit(None).cast("double").alias("location_long"),
        F.col("p_brand").alias("operator"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages (page_id, url, html), spread over the cores when stored as one split."""
    return ensure_parallelism(table(spark, sf_dir, "pages"))


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "surveys": survey_master(spark, sf_dir),
        "wells": well_master(spark, sf_dir),
        "readings": readings(spark, sf_dir),
    }


# The same mapping in SQL, for oracle queries run by DuckDB.
ANALOG_CTES = """
readings AS (
  SELECT CAST(l_suppkey AS BIGINT) AS survey_id, CAST(l_partkey AS BIGINT) AS well_id,
         CAST(l_quantity AS DOUBLE) AS depth, CAST(l_extendedprice AS DOUBLE) AS amplitude,
         CAST(l_returnflag = 'R' AS BIGINT) AS quality_flag, l_shipdate AS ingest_timestamp
  FROM lineitem),
surveys AS (
  SELECT CAST(s_suppkey AS BIGINT) AS survey_type_id, n_name AS survey_type, r_name AS source_format
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                LEFT JOIN region ON n_regionkey = r_regionkey),
wells AS (
  SELECT CAST(p_partkey AS BIGINT) AS well_id, p_name AS well_name,
         CAST(NULL AS DOUBLE) AS location_lat, CAST(NULL AS DOUBLE) AS location_long,
         p_brand AS operator
  FROM part)
"""
