"""Lookups in fixed tables and in caller-supplied grids."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lapsewise import fixed_values as fv
from lapsewise.functions import rules
from lapsewise.functions.amounts import nan_to_null


def literal_table(spark: SparkSession, columns: Mapping[str, list]) -> DataFrame:
    """Small table of constants, planned as a local relation."""
    return spark.createDataFrame(pa.table(dict(columns)))


def lookup(df: DataFrame, key: Column, table: DataFrame, table_key: str, values: Mapping[str, str]) -> DataFrame:
    """Left join with a fixed table; ``values`` maps its columns to output names.

    Only for tables whose size is fixed in the code: they are broadcast.
    """
    side = table.select(F.col(table_key).alias("__key"), *[F.col(c).alias(out) for c, out in values.items()])
    return df.join(F.broadcast(side), key == F.col("__key"), "left").drop("__key")


def dial_prefixes(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark, {"department": list(fv.DIAL_PREFIX), "prefix": list(fv.DIAL_PREFIX.values())}
    )


def add_dial_prefix(df: DataFrame, department: str, out: str = "indicatif") -> DataFrame:
    """Dial prefix of the department, '-' when it is missing, unknown or not a number."""
    number = F.col(department).cast("string").try_cast("bigint")
    joined = lookup(df, number, dial_prefixes(df.sparkSession), "department", {"prefix": out})
    return joined.withColumn(out, F.coalesce(out, F.lit(fv.NO_PREFIX)))


def product_ladder(spark: SparkSession) -> DataFrame:
    """The product ladder: code, next code, family and label."""
    codes, following, families, labels = (list(c) for c in zip(*fv.PRODUCT_LADDER))
    return literal_table(spark, {"code": codes, "next_code": following, "family": families, "label": labels})


def add_ladder(df: DataFrame, product: str, text: str, action: str | None = None) -> DataFrame:
    """Label, family and, given the action id, the proposed product."""
    ladder = product_ladder(df.sparkSession)
    values = {"next_code": "__next", "family": "__family", "label": "__label"}
    joined = lookup(df, F.col(product), ladder, "code", values)
    added = {
        "product_label": rules.product_label(F.col(product), F.col("__label"), F.col(text)),
        "product_family": rules.product_family(F.col("__family")),
    }
    if action:
        added["proposed_product"] = rules.proposed_product(F.col(action), F.col(product), F.col("__next"))
    return joined.withColumns(added).drop("__next", "__family", "__label")


def known_formula(column: Column) -> Column:
    """Whether a product code is on the ladder."""
    return F.coalesce(column.isin(*[row[0] for row in fv.PRODUCT_LADDER]), F.lit(False))


def add_price(
    df: DataFrame,
    grid: DataFrame,
    age: str,
    department: str | None = None,
    formula_out: str = "formula",
    price_out: str = "price",
) -> DataFrame:
    """Formula and price from a grid ``([department,] age_min, age_max, formula, price)``.

    The bands of a department are one sorted array, joined by the department alone, in which every row looks up its
    own: no range join, and no age beyond which bands end. A band may be open at either end (NULL). A
    fractional age counts as the years completed; bands that overlap multiply rows.
    """
    open_ = float("inf")
    band = F.struct(
        F.coalesce(F.col("age_min").cast("double"), F.lit(-open_)).alias("low"),
        F.coalesce(F.col("age_max").cast("double"), F.lit(open_)).alias("high"),
        "formula", "price",
    )
    bands = F.sort_array(F.collect_list(band)).alias("__bands")
    if department:
        by = grid.groupBy(F.col("department").alias("__department")).agg(bands)
        joined = df.join(by, F.col(department) == F.col("__department"), "left").drop("__department")
    else:
        joined = df.withColumn("__bands", grid.agg(bands).scalar())
    years = F.floor(nan_to_null(F.col(age).cast("double")))
    found = F.filter("__bands", lambda b: (b["low"] <= years) & (years <= b["high"]))
    spelled = joined.select(*[F.col(f"`{c}`") for c in df.columns], F.explode_outer(found).alias("__band"))
    return spelled.withColumns({formula_out: F.col("__band.formula"), price_out: F.col("__band.price")}).drop("__band")
