"""Versioned rows: latest version, one row per key, union of lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from lapsewise.operators.skew import attach_group


def keep_latest(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Rows whose version is the highest of their key; ties stay, NULL versions go."""
    known = df.where(F.col(version).isNotNull())
    latest = attach_group(known, keys, [F.max(version).alias("__latest")])
    return latest.where(F.col("__latest") == F.col(version)).drop("__latest")


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], null_keys: str = "keep"
) -> DataFrame:
    """One row per key, the first in ``order``.

    Rows without a key are not versions of one another: all of them stay, or none with
    ``null_keys="drop"``, or one with ``"group"``, as if NULL were a key. A key is missing if
    one of its columns is.

    Spark cuts each key to its first row in every map task before the shuffle
    (``WindowGroupLimit``), so that a hot key costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    missing = F.lit(False) if null_keys == "group" else reduce(or_, [F.col(k).isNull() for k in keys])
    first = df.where(~missing).withColumn("__place", F.row_number().over(window)).where("__place = 1").drop("__place")
    return first if null_keys != "keep" else first.unionByName(df.where(missing))


def union_all(spark: SparkSession, frames: Sequence[DataFrame], schema: StructType | str) -> DataFrame:
    """All rows of all frames by column name, missing columns NULL; no frames, no rows."""
    result = spark.createDataFrame([], schema)
    for frame in frames:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
