"""Wide and long measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lapsewise.functions.dates import month_name
from lapsewise.functions.text import measure_kind, measure_product


def with_name_parts(long: DataFrame, period: str = "month") -> DataFrame:
    """Split ``name`` into ``kind`` and ``product``; add year and month name of monthly rows."""
    name = F.col("name")
    long = long.withColumns({"kind": measure_kind(name), "product": measure_product(name)})
    if period == "month":
        long = long.withColumns({"year": F.substring("month", 1, 4), "month_name": month_name(F.col("month"))})
    return long


def to_long(
    wide: DataFrame, value: str = "value", keys: Sequence[str] = ("month", "network"), period: str = "month"
) -> DataFrame:
    """One row per measure that has a value, its name split into parts."""
    measures = [c for c in wide.columns if c not in keys]
    long = wide.unpivot(list(keys), measures, "name", value).where(F.col(value).isNotNull())
    return with_name_parts(long, period)


def to_wide(long: DataFrame, keys: Sequence[str], names: Sequence[str], value: str = "value") -> DataFrame:
    """Back to one column per measure name; the names are given, so no extra job lists them."""
    return long.groupBy(*keys).pivot("name", list(names)).agg(F.first(value, ignorenulls=True))


def pivot_mean(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], measure: str,
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """Mean of the measure, one column per value of ``column``."""
    wide = df.groupBy(*keys).pivot(column, list(values)).agg(F.avg(measure))
    return wide.withColumnsRenamed(dict(zip(values, labels))) if labels else wide
