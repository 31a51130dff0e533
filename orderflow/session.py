"""Session settings the library expects, and a helper for tests and the bench."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark SQL confs.
RECOMMENDED_CONF = {
    # runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # switch a sort-merge join to broadcast only when the *measured* side is small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # one time zone for every date computation
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def apply_conf(spark: SparkSession) -> None:
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Within, Spark drops a query's shuffle files when the query ends (else when the
    driver next collects garbage). For queries whose results are written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)


_FALLBACK_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only with a local master, and none configured (tests, the bench), a folder
    of our own is made, once per application; it is also registered as the
    checkpoint folder. On a cluster that would be one machine's disk, so there
    the setting is required.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = sc.applicationId
    if app not in _FALLBACK_DIRS:
        _FALLBACK_DIRS[app] = tempfile.mkdtemp(prefix="orderflow-ckpt-", dir="/tmp")
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(_FALLBACK_DIRS[app])
    return _FALLBACK_DIRS[app]


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "orderflow") -> SparkSession:
    """A local session for tests and the bench (UI off, no extra servers); its
    scratch, warehouse and checkpoint folders are this machine's own."""
    scratch = tempfile.mkdtemp(prefix="orderflow-", dir="/tmp")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ORDERFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.local.dir", scratch)
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.checkpoint.dir", os.environ.get("ORDERFLOW_CHECKPOINT_DIR")
                or os.path.join(scratch, "checkpoints"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
