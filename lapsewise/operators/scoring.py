"""Feature frames and regression metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def feature_frame(
    df: DataFrame,
    categories: Sequence[str],
    numbers: Sequence[str],
    labels: Sequence[str] = (),
    extra: Sequence[str] = (),
) -> DataFrame:
    """Model inputs, with label or display columns; missing numbers are 0, categories ``NULL``."""
    return df.select(*categories, *numbers, *labels, *extra).na.fill(0, list(numbers)).na.fill("NULL", list(categories))


def regression_metrics(
    df: DataFrame, actual: str, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """MSE, RMSE, R-squared, MAE and explained variance, over all rows or per segment.

    One pass over mergeable moments; no row order or second pass is involved.
    """
    y, p = F.col(actual).cast("double"), F.col(prediction).cast("double")
    moments = df.where(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.avg((y - p) * (y - p)).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("__var_y"),
        F.var_pop(p).alias("__var_p"),
        (F.avg(p) - F.avg(y)).alias("__shift"),
    )
    mse, shift = F.col("mse"), F.col("__shift")
    return moments.select(
        *by,
        "mse",
        F.sqrt(mse).alias("rmse"),
        (F.lit(1.0) - F.try_divide(mse, F.col("__var_y"))).alias("r2"),
        "mae",
        (F.col("__var_p") + shift * shift).alias("explained_variance"),
    )


def rmse(actual: Column, prediction: Column) -> Column:
    """Root mean squared error as an aggregate."""
    gap = actual.cast("double") - prediction.cast("double")
    return F.sqrt(F.avg(gap * gap))
