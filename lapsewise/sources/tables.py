"""Catalog tables: snapshots, the configurable loader, and table lookup by name parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lapsewise.operators.snapshots import keep_latest


def snapshot(df: DataFrame, partition: str | int, column: str = "dt_partition") -> DataFrame:
    """Rows of one snapshot. The literal takes the column's type, so partitions prune."""
    return df.where(F.col(column) == F.lit(str(partition)).cast(df.schema[column].dataType))


def read_snapshot(spark: SparkSession, table: str, partition: str | int, column: str = "dt_partition") -> DataFrame:
    return snapshot(spark.table(table), partition, column)


def shape_table(
    df: DataFrame,
    columns: Sequence[str],
    equals: Mapping[str, str] | None = None,
    contains: Mapping[str, str] | None = None,
    suffixed: Sequence[str] = (),
    suffix: str = "",
    latest_by: tuple[Sequence[str], str] | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Filter, suffix columns with the entity name, keep the latest version, project.

    ``latest_by`` is (keys, version), named as after the suffixing. ``observation``
    receives the row count as ``rows`` when the frame is used, without a job of its own.
    """
    for column, value in (equals or {}).items():
        df = df.where(F.col(column) == F.lit(value).cast(df.schema[column].dataType))
    for column, part in (contains or {}).items():
        df = df.where(F.col(column).contains(part))
    df = df.withColumnsRenamed({c: f"{c}_{suffix}" for c in suffixed})
    if latest_by:
        keys, version = latest_by
        df = keep_latest(df.select(*dict.fromkeys([*columns, *keys, version])), keys, version)
    df = df.select(*columns)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")) if observation else df


def load_table(spark: SparkSession, database: str, table: str, columns: Sequence[str], **options) -> DataFrame:
    """:func:`shape_table` on a catalog table."""
    return shape_table(spark.table(f"{database}.{table}"), columns, **options)


def find_table(spark: SparkSession, database: str, *parts: str) -> str:
    """Name of the one table whose name contains all parts; ``LookupError`` otherwise."""
    names = spark.sql(f"SHOW TABLES IN {database}").where(~F.col("isTemporary")).select("tableName")
    for part in parts:
        names = names.where(F.col("tableName").contains(part))
    found = [row.tableName for row in names.limit(2).collect()]
    if len(found) != 1:
        raise LookupError(f"{'several tables' if found else 'no table'} named like {', '.join(parts)}")
    return found[0]
