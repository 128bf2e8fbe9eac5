"""The churn report: stock, yearly and monthly terminations, and the measures for KPIs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lapsewise import fixed_values as fv
from lapsewise.functions.amounts import ratio
from lapsewise.functions.dates import check_month
from lapsewise.functions.rules import add_health_scopes
from lapsewise.operators.columns import DEFAULT, HEALTH, Names
from lapsewise.operators.measures import exits_by_period, exits_of_spans, narrow_spans, stock_of_spans, terminations_of_spans
from lapsewise.operators.quality import require_rows
from lapsewise.operators.reshape import with_name_parts
from lapsewise.plans.portfolio import load_portfolio
from lapsewise.sources import manifest
from lapsewise.sources.sinks import write_reports
from lapsewise.sources.workspace import stored

STOCK, BY_YEAR, BY_MONTH = "STOCK", "RESIL ANNEE", "RESIL MOIS"


def _spans(
    portfolio: DataFrame, first: str, last: str, flags: Sequence[str], names: Names, store: bool
) -> DataFrame:
    """The columns and rows all counts need, written to the shared folder if ``store``."""
    check_month(first), check_month(last)
    spans = narrow_spans(portfolio, first, last, flags, names)
    return stored(spans, "spans") if store else spans


def churn_report(
    portfolio: DataFrame, first: str, last: str, flags: Sequence[str], names: Names = DEFAULT, store: bool = True
) -> dict[str, DataFrame]:
    """The three reports by network and flag, from a portfolio with flags.

    The spans are read three times, so ``store`` writes them once instead of running
    the joins behind the portfolio again for every count.
    """
    return _reports(_spans(portfolio, first, last, flags, names, store), first, last, flags, names)


def _reports(spans: DataFrame, first: str, last: str, flags: Sequence[str], names: Names) -> dict[str, DataFrame]:
    """The reports from stock and exits, which are a few rows each: counted in one job and written."""
    stock = stock_of_spans(spans, first, last, flags, names).withColumnRenamed("month", "period")
    exits = exits_by_period(spans, first, last, flags=flags, names=names)
    kind = F.col("__kind")
    both = stock.withColumn("__kind", F.lit("stock")).unionByName(exits.withColumn("__kind", F.lit("exits")))
    both = stored(both, "counts")
    stock = both.where(kind == "stock").drop("__kind").withColumnRenamed("period", "month")
    exits = both.where(kind == "exits").drop("__kind")
    by_year, by_month = (
        terminations_of_spans(spans, first, last, period, flags, names, stock=stock, exits=exits) for period in ("year", "month")
    )
    stock = stock.orderBy("month", names.network)
    return {STOCK: stock, BY_YEAR: by_year, BY_MONTH: by_month}


def write_churn_report(
    portfolio: DataFrame, first: str, last: str, flags: Sequence[str], path: str, names: Names = DEFAULT
) -> None:
    """Write the three reports. No active contract in the range is an error, found before any count."""
    spans = require_rows(_spans(portfolio, first, last, flags, names, store=True))
    write_reports(_reports(spans, first, last, flags, names), path)


def report_table(reports: dict[str, DataFrame]) -> DataFrame:
    """All reports in one frame, with ``report`` and ``period`` columns."""
    parts = []
    for name, report in reports.items():
        period = "year" if name == BY_YEAR else "month"
        parts.append(
            report.select(
                F.lit(name).alias("report"),
                F.col(period).alias("period"),
                *[c for c in report.columns if c != period],
            )
        )
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def churn_measures(
    portfolio: DataFrame, first: str, last: str, flags: Sequence[str], names: Names = DEFAULT, store: bool = True
) -> DataFrame:
    """Long monthly stock and terminations with the churn rate, the input of the KPIs.

    The same rows as unpivoting both reports and joining them, with the stock counted once.
    """
    spans = _spans(portfolio, first, last, flags, names, store)
    stock = stock_of_spans(spans, first, last, flags, names)
    keys = ["month", names.network]
    measures = [c for c in stock.columns if c not in keys]
    exits = exits_of_spans(spans, first, last, "month", flags, names)
    wide = stock.join(exits.withColumnsRenamed({m: f"__{m}" for m in measures}), keys, "left")
    pairs = [
        f"struct('{m}' as name, `{m}` as stock, coalesce(`__{m}`, 0L) as terminated)" for m in measures
    ]
    long = wide.selectExpr("month", f"`{names.network}` as network", f"inline(array({', '.join(pairs)}))")
    return with_name_parts(long.where(F.col("stock").isNotNull())).withColumn(
        "rate", ratio(F.col("terminated"), F.col("stock"))
    )


def write_measures(
    portfolio: DataFrame,
    first: str,
    last: str,
    flags: Sequence[str],
    root: str,
    names: Names = DEFAULT,
    store: bool = True,
) -> dict:
    """Store the long measures under their last month, with the months they begin and end in; gives the manifest.

    KPIs of a month read what is stored: a few rows for each month, network and measure instead of the spans.
    """
    spark = portfolio.sparkSession
    run = manifest.Run(spark, root, last)
    measures = run.frame(churn_measures(portfolio, first, last, flags, names, store), "measures")
    ends = measures.agg(F.min("month").alias("first"), F.max("month").alias("last")).first()
    run.notes = ends.asDict()
    return run.commit()


def read_measures(spark: SparkSession, root: str, last: str) -> tuple[DataFrame, str | None]:
    """The stored measures and the last month in them; an error where there are none."""
    found = manifest.lookup(spark, root, last)
    measures = manifest.read_output(spark, root, last, "measures")
    if measures is None:
        raise ValueError(f"no measures stored for {last}")
    return measures, found["notes"]["last"]


def report_from_snapshots(
    tables: Mapping[str, DataFrame],
    partition: str,
    first: str,
    last: str,
    path: str,
    root: str | None = None,
    flags: Sequence[str] = fv.SCOPES,
    **options,
) -> dict[str, DataFrame]:
    """From the snapshot tables to the written churn report: load, scopes, reports, and with ``root`` the measures.

    ``tables`` has the five frames of :func:`portfolio.load_portfolio` under the names of its parameters. The portfolio
    is narrowed to its spans and written once; reports and measures are counted from there.
    """
    loaded = add_health_scopes(load_portfolio(**tables, partition=partition, **options))
    spans = _spans(loaded, first, last, flags, HEALTH, store=True)
    require_rows(spans)
    reports = _reports(spans, first, last, flags, HEALTH)
    write_reports(reports, path)
    if root is not None:
        write_measures(spans, first, last, flags, root, HEALTH, store=False)
    return reports
