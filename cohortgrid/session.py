"""Session helpers for local runs and tests.

Cluster jobs use the session they are given; only local runs build one.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
}


# Suggested settings for a large cluster (about 100 TB of inputs, ~1000
# executors): many initial shuffle partitions that AQE coalesces to the
# advisory size, skew-join splitting, broadcasts only under a measured size.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", app: str = "cohortgrid", **conf: str) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("COHORTGRID_LOG_LEVEL", "ERROR"))
    return spark
