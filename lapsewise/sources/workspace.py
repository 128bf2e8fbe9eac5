"""Shared folder for tables a job writes and reads back."""

from __future__ import annotations

import atexit
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; an error without the setting."""
    folder = spark.sparkContext.getConf().get(SETTING)
    if not folder:
        raise ValueError(f"set {SETTING} to a folder all executors can reach")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; the folder above it goes when Python ends."""
    folder = f"{shared_folder(spark)}/lapsewise-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clear)
    _made.append(folder)
    return f"{folder}/{name}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _clear() -> None:
    context = SparkContext._active_spark_context
    if context is None or context._jsc is None:
        return
    for folder in _made:
        remove(SparkSession(context), folder)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the frame as parquet and read it back: short lineage, computed once."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """The written tables of one job, each of which can be dropped when it has been used."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, new_path(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write under the name, once, and read back."""
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, self.path(name))
