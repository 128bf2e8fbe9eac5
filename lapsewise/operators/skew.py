"""Attaching one row per group to many rows when groups may be huge.

A window over the group would send all its rows to one task. Here the group's row is joined
back, and Spark splits the partitions of hot groups at run time, however many there are.
It only does so where both sides of the join are shuffled for the join's sake. An aggregate
is partitioned by the same keys already and would be joined as it lies, so a hash of the
keys takes part in the join as a key of its own, which asks for a shuffle of the (small) group side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def attach_row(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join with ``other``, which has one row per key, the keys of both named alike.

    NULL keys match NULL keys.
    """
    keys, names = list(keys), [c for c in other.columns if c not in keys]
    left = df.withColumn("__hash", F.xxhash64(*keys)).alias("d")
    right = other.select("*", F.xxhash64(*keys).alias("__hash")).alias("o")
    same: list[Column] = [F.col(f"d.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    joined = left.join(right, reduce(lambda a, b: a & b, same, F.col("d.__hash") == F.col("o.__hash")), "left")
    return joined.select(*[F.col(f"d.{c}") for c in df.columns], *[F.col(f"o.{c}") for c in names])


def attach_group(
    df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], source: DataFrame | None = None
) -> DataFrame:
    """``df`` with the (aliased) aggregates of each row's group; NULL keys form a group.

    The aggregates are taken over ``source`` if given, of which ``df`` is a part. Every task
    combines its own rows of a group first, so a hot group sends one row per task.
    """
    return attach_row(df, (df if source is None else source).groupBy(*keys).agg(*aggregates), keys)
