"""Tables kept for a while in the folder that all machines share, and folders swapped by renames."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from portalmeter.session import folder_exists, shared_dir


class Staging:
    """Tables that are read more than once, written as Parquet below the shared folder; ``clear`` removes them.

    A lost executor loses nothing of such a table, and what it was computed from is computed once.
    """

    def __init__(self, spark: SparkSession, fallback: str | None = None):
        self.spark = spark
        self.root = f"{shared_dir(spark, fallback).rstrip('/')}/staging-{uuid.uuid4().hex}"
        self._count = 0

    def save(self, df: DataFrame) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        delete(self.spark, self.root)


def _path(spark: SparkSession, path: str):
    """A path as Hadoop has it, and its file system."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path, system = _path(spark, path)
    system.delete(hadoop_path, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    hadoop_path, system = _path(spark, source)
    if not system.rename(hadoop_path, _path(spark, target)[0]):
        raise OSError(f"{source} could not be renamed to {target}")


class FolderSwap:
    """Puts a folder in the place of another such that a crash at any step can be made good.

    New rows go to ``_new-<name>`` beside the folder, which is whole once it holds ``_SUCCESS``. Then the folder is
    renamed to ``_old-<name>``, the new one to the folder's name, and the old one is deleted. Spark's readers pass over
    names that begin with an underscore. ``recover`` goes on where a crash left off: forward if the new folder is whole
    and the old one out of the way, else back. Needs a file system whose renames of folders are atomic.
    """

    def __init__(self, spark: SparkSession, parent: str, name: str):
        self.spark = spark
        # Readers would not pass over a name with an equals sign.
        beside = name.replace("=", "-")
        self.place, self.new, self.old = f"{parent}/{name}", f"{parent}/_new-{beside}", f"{parent}/_old-{beside}"

    def recover(self) -> None:
        exists = lambda path: folder_exists(self.spark, path)
        if exists(self.old):
            if not exists(self.place):
                rename(self.spark, self.new if exists(f"{self.new}/_SUCCESS") else self.old, self.place)
            delete(self.spark, self.old)
        delete(self.spark, self.new)

    def replace(self, rows: DataFrame) -> None:
        """Writes the rows, which may come from the folder itself, and swaps them in."""
        self.recover()
        rows.write.parquet(self.new)
        if folder_exists(self.spark, self.place):
            rename(self.spark, self.place, self.old)
        rename(self.spark, self.new, self.place)
        delete(self.spark, self.old)
