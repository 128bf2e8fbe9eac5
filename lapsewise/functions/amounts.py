"""Numeric expressions. NaN counts as missing everywhere."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def floor_to_step(value: Column, step: int) -> Column:
    """Lower bound of the amount's bucket; missing counts as 0, negatives go down."""
    return F.floor(F.coalesce(nan_to_null(value), F.lit(0.0)) / F.lit(step)) * F.lit(step)


def monthly_amount(yearly: Column) -> Column:
    """Twelfth of a yearly amount cut to an integer; missing counts as 0, NULL beyond 32 bits."""
    return (F.coalesce(nan_to_null(yearly), F.lit(0.0)) / F.lit(12)).try_cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, NULL when the divisor is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage rounded half to even."""
    return F.bround(ratio(part, whole) * 100, digits)


def gap(actual: Column, other: Column) -> Column:
    return F.abs(actual - other)


def gap_percent(actual: Column, other: Column) -> Column:
    return ratio(gap(actual, other), actual) * 100


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(condition, 1).otherwise(0)


def id_when(condition: Column, value: Column) -> Column:
    """The id where the condition holds, else NULL, which distinct counts skip."""
    return F.when(condition, value)
