"""Registered queries: commit-log history and active files of a versioned table.

The log is one of a table whose readings arrived one year per version (those
without a timestamp last) and that was then replaced by the whole table; the
commits are written from the readings by a DataFrame job (``fixtures``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans import fixtures as FIX
from strata.plans.registry import register
from strata.plans.stream_queries import GAPS_CTE, with_gaps
from strata.session import scratch_dir
from strata.sources import analog
from strata.sources import deltalog as L

LOG_SQL = "WITH " + analog.ANALOG_CTES + GAPS_CTE + """,
years AS (
  SELECT y, row_number() OVER (ORDER BY y NULLS LAST) - 1 AS version, n,
         CAST(sum(n) OVER (ORDER BY y NULLS LAST) AS BIGINT) AS cumulative
  FROM (SELECT year(ingest_timestamp) AS y, count(*) AS n FROM gaps GROUP BY y))
"""


def _log(spark, sf_dir, **kw) -> str:
    root = scratch_dir(spark, "log") + "/readings"
    FIX.write_commit_log(with_gaps(analog.readings(spark, sf_dir)), root, **kw)
    return root


@register("log_history", LOG_SQL + """
SELECT version, 'WRITE' AS operation, CASE WHEN version = 0 THEN 'Overwrite' ELSE 'Append' END AS mode,
       n AS num_added_rows
FROM years
UNION ALL
SELECT (SELECT count(*) FROM years), 'WRITE', 'Overwrite', (SELECT count(*) FROM gaps)""")
def q_log_history(spark, sf_dir):
    return L.history(spark, _log(spark, sf_dir)).select("version", "operation", "mode", "num_added_rows")


@register("log_active_files", LOG_SQL + """
SELECT version, cumulative AS active_rows, version + 1 AS active_versions FROM years
UNION ALL
SELECT (SELECT count(*) FROM years), (SELECT count(*) FROM gaps), 1""")
def q_log_active_files(spark, sf_dir):
    """Rows and contributing versions of the files live at every version."""
    return L.activity(spark, _log(spark, sf_dir)).select("version", "active_rows", "active_versions")


@register("log_checkpoint", LOG_SQL + """
SELECT added_in_version, sum(n)::BIGINT AS active_rows
FROM (SELECT greatest(version, 2) AS added_in_version, n FROM years WHERE version <= 4) GROUP BY added_in_version""")
def q_log_checkpoint(spark, sf_dir):
    """Files live at version 4 of a log whose first three commits are gone; a checkpoint holds their state."""
    root = _log(spark, sf_dir, keep_from=3, checkpoint=2)
    return L.active_files(spark, root, 4).groupBy("added_in_version").agg(F.sum("num_records").cast("bigint").alias("active_rows"))
