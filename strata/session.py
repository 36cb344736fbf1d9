"""Session and shared-folder helpers.

Everything that has to survive an executor loss (lineage cuts, side outputs of a
job, scratch tables) lives under the shared folder named by
``spark.checkpoint.dir``.  A session that does not name one (tests, a laptop)
gets a private one here; a cluster session keeps its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from static size estimates (compressed file sizes, not a
    # bound); broadcasts come from checked byte bounds (plans/joins.py) or from
    # AQE, which measures the real shuffle output first.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "strata",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Only a local session, whose executors are threads of the driver, gets a
    private one when it names none; on a cluster that would be a folder that
    other machines cannot see, so it is an error there.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        if not is_private(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def is_private(master: str) -> bool:
    """Whether a master runs its tasks in the driver's own process."""
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh (not yet created) folder for one job's outputs, inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers without installing it.

    Functions and Data Source classes are pickled by value, so executors need
    no copy of the package on their path.
    """
    from pyspark import cloudpickle

    import strata

    try:
        cloudpickle.register_pickle_by_value(strata)
    except ValueError:
        pass  # already registered
