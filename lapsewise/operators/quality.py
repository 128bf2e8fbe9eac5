"""Checks and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def funnel(df: DataFrame, steps: Mapping[str, Column], start: str = "start", ids: str | None = None) -> DataFrame:
    """Rows left after each filter step, all counted in one pass; with ``ids`` also the different ids left.

    A row passes a number of leading steps, and an id as many as the best of its rows. So distinct ids cost one
    combining aggregation to a row for each id, whatever the number of steps. A NULL id is counted in rows only.
    """
    passed, condition = F.lit(0), F.lit(True)
    for step in steps.values():
        condition = condition & F.coalesce(step, F.lit(False))
        passed = passed + condition.cast("int")
    numbers = range(len(steps) + 1)
    counts = [F.count_if(F.col("__passed") >= i).alias(f"c{i}") for i in numbers]
    marked = df.select(*([F.col(ids).alias("__id")] if ids else []), passed.alias("__passed"))
    if ids:
        each = marked.groupBy("__id").agg(F.max("__passed").alias("__most"), *counts)
        known = F.col("__id").isNotNull()
        counted = each.agg(
            *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in numbers],
            *[F.count_if(known & (F.col("__most") >= i)).alias(f"d{i}") for i in numbers],
        )
    else:
        counted = marked.agg(*counts)
    rows = [
        F.struct(
            F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col(f"c{i}").alias("rows"),
            *([F.col(f"d{i}").alias("ids")] if ids else []),
        )
        for i, name in enumerate([start, *steps])
    ]
    return counted.select(F.inline(F.array(*rows)))


def apply_steps(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    for step in steps.values():
        df = df.where(step)
    return df


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found on more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, or ``ValueError`` when a key repeats and a join on it would multiply rows."""
    if not repeated_keys(df, keys).isEmpty():
        raise ValueError(f"repeated keys: {', '.join(keys)}")
    return df


def require_rows(df: DataFrame, message: str = "no rows: is the snapshot right?") -> DataFrame:
    """``df`` itself, or ``ValueError`` when it is empty."""
    if df.isEmpty():
        raise ValueError(message)
    return df
