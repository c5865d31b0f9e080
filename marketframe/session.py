"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings every operator relies on. Nothing here depends on the size
# of the cluster: the number of shuffle partitions stays the deployment's.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # merge small shuffle pieces, but leave enough tasks for costly expressions
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that the driver and all executors share.

    The cluster names one in ``spark.checkpoint.dir``; without it the folder
    lies in the warehouse, unless that is a machine's own disk (Spark's default) on a cluster.
    """
    base, warehouse = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.sql.warehouse.dir", None)
    own_disk = warehouse and warehouse.startswith(("file:", "/")) and not spark.conf.get("spark.master", "").startswith("local")
    if not base and (not warehouse or own_disk):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = base or warehouse.rstrip("/") + "/_work"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
