"""Churn KPIs over long measures: stock joined with terminations.

These frames have one row per month, network and measure; their size follows the
calendar and the product range, not the number of contracts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lapsewise import fixed_values as fv
from lapsewise.functions.amounts import percent, ratio
from lapsewise.functions.text import compact_thousands, stock_label
from lapsewise.operators.measures import CONTRACTS
from lapsewise.operators.reshape import pivot_mean

GROUP = ("network", "product")


def monthly_rates(stock: DataFrame, terminated: DataFrame) -> DataFrame:
    """Long stock and terminations side by side with ``rate``, the monthly churn."""
    keys = ["month", "network", "name"]
    return stock.join(terminated.select(*keys, "terminated"), keys, "inner").withColumn(
        "rate", ratio(F.col("terminated"), F.col("stock"))
    )


def _dated(df: DataFrame, last: str | None) -> DataFrame:
    """Add the last month, the same month a year ago, and the years of both.

    Unless given, the last month is looked up in the frame as a scalar subquery.
    """
    end = F.lit(last) if last else df.agg(F.max("month")).scalar()
    dated = df.withColumn("__last", end).withColumn("__ago", (F.col("__last").cast("int") - 100).cast("string"))
    return dated.withColumns({"__year": F.substring("__last", 1, 4), "__before": F.substring("__ago", 1, 4)})


HELPERS = ("__last", "__ago", "__year", "__before")


def annual_rates(df: DataFrame, kind: str = CONTRACTS) -> DataFrame:
    """First stock, terminations and annual churn in percent by year, network and product."""
    return (
        df.where(F.col("kind") == kind)
        .groupBy("year", *GROUP)
        .agg(F.min_by("stock", "month").alias("stock"), F.sum("terminated").alias("terminated"))
        .withColumn("annual_rate", percent(F.col("terminated"), F.col("stock")))
    )


def year_to_date_share(df: DataFrame, last: str | None = None, kind: str = CONTRACTS) -> DataFrame:
    """Share of last year's terminations that had fallen by this time of the year."""
    in_year = F.col("year") == F.col("__before")
    early = F.sum(F.when(in_year & (F.col("month") <= F.col("__ago")), F.col("terminated")))
    whole = F.sum(F.when(in_year, F.col("terminated")))
    return _dated(df, last).where(F.col("kind") == kind).groupBy(*GROUP).agg(ratio(early, whole).alias("share"))


def annualised_rates(df: DataFrame, last: str | None = None, kind: str = CONTRACTS) -> DataFrame:
    """This year's churn so far scaled to a whole year by last year's share."""
    end = F.lit(last) if last else df.agg(F.max("month")).scalar()
    current = annual_rates(df, kind).where(F.col("year") == F.substring(end, 1, 4))
    share = year_to_date_share(df, last, kind)
    return current.join(share, list(GROUP), "inner").withColumn(
        "annualised_rate", F.bround(ratio(F.col("annual_rate"), F.col("share")), 1)
    )


def selection(df: DataFrame, network: str, product: str, kind: str) -> DataFrame:
    """The series of one network, product and kind."""
    return df.where((F.col("network") == network) & (F.col("product") == product) & (F.col("kind") == kind))


def selection_kpis(
    df: DataFrame, base_year: str, last: str | None = None, keys: Sequence[str] = ("network", "product", "kind")
) -> DataFrame:
    """Rates of the base year, last year and this year scaled up, per series, in one pass."""
    year, month, terminated = F.col("year"), F.col("month"), F.col("terminated")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, terminated))

    def january(of: Column) -> Column:
        return F.max(F.when(month == F.concat(of, F.lit("01")), F.col("stock")))

    sums = _dated(df, last).groupBy(*keys).agg(
        total((year == F.col("__year")) & (month <= F.col("__last"))).alias("this_year"),
        total(year == F.col("__before")).alias("last_year"),
        total((year == F.col("__before")) & (month <= F.col("__ago"))).alias("last_year_to_date"),
        total(year == base_year).alias("base_year"),
        january(F.lit(base_year)).alias("stock_base"),
        january(F.col("__before")).alias("stock_last"),
        january(F.col("__year")).alias("stock_this"),
    )
    scaled = ratio(F.col("this_year").cast("double") * F.col("last_year"), F.col("last_year_to_date"))
    return sums.withColumns(
        {
            "rate_base": percent(F.col("base_year"), F.col("stock_base")),
            "rate_last": percent(F.col("last_year"), F.col("stock_last")),
            "rate_this": percent(scaled, F.col("stock_this")),
        }
    )


def stock_per_year(annual: DataFrame, years: Sequence[str]) -> DataFrame:
    """First stock of each year in thousands, one column per year."""
    wide = pivot_mean(annual, GROUP, "year", years, "stock")
    return wide.select(*GROUP, *[compact_thousands(F.col(y)).alias(y) for y in years])


def rate_per_year(annual: DataFrame, years: Sequence[str]) -> DataFrame:
    return pivot_mean(annual, GROUP, "year", years, "annual_rate")


def months_table(
    df: DataFrame, measure: str, keys: Sequence[str] = ("network", "product", "kind"), labels: bool = True
) -> DataFrame:
    """Year by month table of a measure, twelve fixed month columns."""
    return pivot_mean(
        df, [*keys, "year"], "month_name", fv.MONTH_NAMES, measure, fv.MONTH_LABELS if labels else None
    )


def terminations_table(df: DataFrame, keys: Sequence[str] = ("network", "product", "kind")) -> DataFrame:
    """Terminations by month, each year labelled with its January stock, without the first year."""
    number = F.substring("month", 5, 2)
    months = [
        F.avg(F.when(number == f"{i:02d}", F.col("terminated"))).alias(label) for i, label in enumerate(fv.MONTH_LABELS, 1)
    ]
    january = F.max(F.when(number == "01", F.col("stock"))).alias("__stock")
    table = df.groupBy(*keys, "year").agg(*months, january)
    return (
        table.withColumn("__oldest", df.agg(F.min("year")).scalar())
        .where(F.col("year") > F.col("__oldest"))
        .withColumn("label", stock_label(F.col("year"), F.col("__stock")))
        .drop("__stock", "__oldest")
    )


def two_year_series(df: DataFrame, last: str | None = None) -> DataFrame:
    """Monthly rates of this year and last year in order."""
    recent = _dated(df, last).where((F.col("year") == F.col("__year")) | (F.col("year") == F.col("__before")))
    return recent.drop(*HELPERS).orderBy("network", "product", "kind", "month")


def product_list(df: DataFrame, kind: str = CONTRACTS) -> DataFrame:
    """Sorted products of each network."""
    return df.where(F.col("kind") == kind).select(*GROUP).distinct().orderBy(*GROUP)
