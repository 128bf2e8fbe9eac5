"""Validity spans of contracts and their expansion to months.

Both ends of a span are inclusive months; a NULL end is open, a NULL start unbounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lapsewise import fixed_values as fv
from lapsewise.functions.dates import month_key, month_number, month_number_of, month_start
from lapsewise.operators.columns import DEFAULT, Names
from lapsewise.operators.skew import attach_group


def drop_empty(df: DataFrame, names: Names = DEFAULT) -> DataFrame:
    """Drop contracts opened and closed at the same time."""
    start, end = F.col(names.start), F.col(names.end)
    return df.where((start != end) | end.isNull())


def active_between(df: DataFrame, first: str, last: str, names: Names = DEFAULT) -> DataFrame:
    """Rows with a month between ``first`` and ``last``; plain comparisons that reach the scan."""
    start, end = F.col(names.start), F.col(names.end)
    after_last = F.add_months(month_start(last), 1)
    return df.where((start.isNull() | (start < after_last)) & (end.isNull() | (end >= month_start(first)))).where(
        start.isNull() | end.isNull() | (F.trunc(start, "MM") <= F.trunc(end, "MM"))
    )


def within_months(df: DataFrame, first: str, last: str, names: Names = DEFAULT) -> DataFrame:
    """Add ``lo`` and ``hi``, the first and last active month counted from ``first``."""
    base, top = month_number_of(first), month_number_of(last) - month_number_of(first)
    lo = F.greatest(month_number(F.col(names.start)) - base, F.lit(0))
    hi = F.least(month_number(F.col(names.end)) - base, F.lit(top))
    return active_between(df, first, last, names).withColumns({"lo": lo, "hi": hi})


def list_months(df: DataFrame, first: str, last: str, names: Names = DEFAULT) -> DataFrame:
    """The active months of each span as an ascending list ``months`` of month numbers, in its own row; spans without any go."""
    base = month_number_of(first)
    listed = within_months(df, first, last, names).withColumn("months", F.sequence(F.col("lo") + base, F.col("hi") + base))
    return listed.drop("lo", "hi")


def expand_months(df: DataFrame, first: str, last: str, names: Names = DEFAULT) -> DataFrame:
    """One row per active month, with ``month`` (yyyyMM) and ``year``."""
    start = F.trunc(F.greatest(F.col(names.start).cast("date"), month_start(first)), "MM")
    end = F.trunc(F.least(F.col(names.end).cast("date"), month_start(last)), "MM")
    # sequence() fails on a reversed range
    months = F.when(start <= end, F.sequence(start, end, F.expr("interval 1 month")))
    return (
        df.select("*", F.explode(months).alias("__month"))
        .withColumn("month", F.lpad((F.year("__month") * 100 + F.month("__month")).cast("string"), 6, "0"))
        .withColumn("year", F.substring("month", 1, 4))
        .drop("__month")
    )


def open_end() -> Column:
    return F.lit(fv.OPEN_END).cast("date")


def merge_ends(df: DataFrame, names: Names = DEFAULT, source: DataFrame | None = None) -> DataFrame:
    """Give every version of a contract the latest end of all of them.

    Replaced contracts thus count as one; an open version makes the contract open.
    ``source`` holds all versions when ``df`` has only some.
    """
    end = F.coalesce(F.col(names.end).cast("date"), open_end())
    merged = attach_group(df, [names.contract], [F.max(end).alias("__end")], source)
    return merged.withColumn(names.end, F.col("__end")).drop("__end")


def monthly_portfolio(df: DataFrame, first: str, last: str, names: Names = DEFAULT) -> DataFrame:
    """Contract-months with the merged end and its ``exit_month`` and ``exit_year``.

    Ends are merged before the expansion, over versions active in the range only, so
    the shuffle carries contracts and not contract-months.
    """
    spans = drop_empty(active_between(df, first, last, names), names)
    merged = _with_exit(spans, names)
    expanded = expand_months(merged, first, last, _own(names))
    return expanded.select(*df.columns, "month", "year", "exit_month", "exit_year")


def listed_portfolio(df: DataFrame, first: str, last: str, names: Names = DEFAULT) -> DataFrame:
    """:func:`monthly_portfolio` with one row per span and its months as a list."""
    merged = _with_exit(drop_empty(active_between(df, first, last, names), names), names)
    return list_months(merged, first, last, _own(names)).drop("__own_end")


def _own(names: Names) -> Names:
    return Names(names.contract, names.client, names.start, "__own_end", names.network)


def _with_exit(spans: DataFrame, names: Names) -> DataFrame:
    """Spans with the merged end and what follows from it, and the end of their own; written once a span, not once a month."""
    end = F.col(names.end)
    merged = merge_ends(spans.withColumn("__own_end", end), names)
    return merged.withColumns({"exit_month": month_key(end), "exit_year": F.year(end).cast("string")})
