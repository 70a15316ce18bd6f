"""Session settings the library relies on."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Only the months a load writes are replaced, never the whole table.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    ``fallback`` takes its place only where all tasks run in this process; on a cluster it would be a folder of one
    machine.
    """
    directory = spark.conf.get("spark.checkpoint.dir", None)
    if not directory and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        directory = fallback
    if not directory:
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return directory


def folder_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)
