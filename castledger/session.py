"""Session settings that suit these jobs on a cluster and on a laptop."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Split hot join partitions even when that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Call-site capture costs a driver round trip per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "castledger", master: str | None = None,
                  **settings: str) -> SparkSession:
    """Session with ``SETTINGS``; ``settings`` win. Shuffle partitions stay with
    the caller: they depend on the cluster (adaptive execution merges small ones)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: ``spark.checkpoint.dir``.
    Where it is unset, the warehouse will do only if driver and executors are one
    process; elsewhere it could be a disk of the driver alone."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
