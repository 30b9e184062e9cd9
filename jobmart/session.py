"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings that results depend on (time zone) or that keep big joins healthy.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("jobmart")
    local = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
    }
    for key, value in (SETTINGS | local | settings).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    A session without that setting uses a folder in its warehouse, which the driver and the executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "scratch")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_folder(spark), "jobmart", f"{name}-{uuid.uuid4().hex}")
