"""Sinks: datasets written by many tasks, one folder each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_frame(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_reports(reports: Mapping[str, DataFrame], path: str) -> None:
    """One dataset per report under ``report=<name>``."""
    for name, report in reports.items():
        write_frame(report, f"{path}/report={name}")


def append_run(
    spark: SparkSession,
    path: str,
    variables: Sequence[str],
    params: str,
    training: DataFrame,
    dev: DataFrame,
    test: DataFrame,
    date: datetime | None = None,
) -> None:
    """Append one training run: date, variables, parameters and three one-row metric frames.

    Metric columns are prefixed ``Training_``, ``Dev_`` and ``Test_``.
    """
    stamp = (date or datetime.now()).strftime("%Y_%m_%d-%H_%M_%S")

    def prefixed(metrics: DataFrame, prefix: str) -> list:
        one_row = metrics.agg(F.first(F.struct(*metrics.columns))).scalar()
        return [one_row[c].alias(f"{prefix}_{c}") for c in metrics.columns]

    row = spark.range(1).select(
        F.lit(stamp).alias("Date"),
        F.lit("/".join(variables)).alias("Variables"),
        F.lit(params).alias("Params"),
        *prefixed(training, "Training"),
        *prefixed(dev, "Dev"),
        *prefixed(test, "Test"),
    )
    row.write.mode("append").parquet(path)


def write_contact_list(df: DataFrame, path: str, campaign: str, role: str, month_end: str) -> None:
    """One contact or control list in the layout :func:`files.read_contact_lists` reads."""
    write_csv(df, f"{path}/campaign={campaign}/role={role}/month_end={month_end}")
