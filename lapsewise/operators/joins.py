"""Joins of portfolio rows with reference tables and id lists.

No caller's frame is hinted for broadcast, as it may grow: Spark broadcasts one only
where its measured size allows. Joins with a reference table are plain shuffle joins,
whose hot partitions Spark splits at run time; id lists lose their repeats first and
are joined through :mod:`skew`, so that theirs are split too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lapsewise.functions.text import upper_or_empty
from lapsewise.operators.skew import attach_row


def add_reference(df: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on shared column names."""
    return df.join(reference, list(keys), "left")


def match_distinct(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on shared column names without repeated rows.

    Rows without a partner go first, so that only the others are compared for copies;
    copies go before the join, where they would multiply. Copies are found in sorted rows: a
    hash aggregate holds every different row of a task two times, a sort spills, and its order serves the join.
    """
    keys, other = list(keys), other.distinct()
    matched = df.join(other.select(*keys).distinct(), keys, "left_semi")
    columns = [F.col(f"`{c}`") for c in [*keys, *(c for c in matched.columns if c not in keys)]]
    copy = F.row_number().over(Window.partitionBy(*columns).orderBy(columns[0]))
    once = matched.withColumn("__copy", copy).where("__copy = 1").drop("__copy")
    return once.join(other, keys, "inner")


def _marked(df: DataFrame, key: str, members: DataFrame, member: str) -> DataFrame:
    """``df`` with ``__member``, true for keys among the members and NULL for all others."""
    ids = members.where(F.col(member).isNotNull()).select(F.col(member).alias(key)).distinct()
    return attach_row(df, ids.withColumn("__member", F.lit(True)), [key])


def mark_members(df: DataFrame, key: str, members: DataFrame, member: str, out: str) -> DataFrame:
    """Boolean column: is the key among the members? Never multiplies rows."""
    marked = _marked(df, key, members, member)
    return marked.withColumn(out, F.coalesce("__member", F.lit(False))).drop("__member")


def mark_text(
    df: DataFrame, key: str, members: DataFrame, member: str, out: str, yes: str, no: str
) -> DataFrame:
    """As :func:`mark_members` with texts, e.g. ``O``/``N`` or ``DONE``/``-``."""
    marked = mark_members(df, key, members, member, out)
    return marked.withColumn(out, F.when(F.col(out), yes).otherwise(no))


def exclude_members(df: DataFrame, key: str, members: DataFrame, member: str) -> DataFrame:
    """Rows whose key is not among the members; rows without a key stay."""
    return _marked(df, key, members, member).where("__member is null").drop("__member")


def keep_members(df: DataFrame, key: str, members: DataFrame, member: str) -> DataFrame:
    """Rows whose key is among the members."""
    return _marked(df, key, members, member).where("__member").drop("__member")


def add_by_upper_key(
    df: DataFrame, key: str, other: DataFrame, other_key: str, both_sides: bool = False, repeats: str = "all"
) -> DataFrame:
    """Left join on the upper-cased key, which replaces the key column; a missing key becomes ''.

    The other side's key is taken as it is unless ``both_sides``. Rows without a key, and blank
    keys of the other side, take no part in the join. A key that repeats on the other side
    multiplies rows, or gives the first of its rows by all columns with ``repeats="first"``.
    """
    left = df.withColumn(key, upper_or_empty(F.col(key)))
    right_key: Column = F.upper(F.col(other_key)) if both_sides else F.col(other_key)
    right = other.withColumn("__other", right_key).where(F.trim("__other") != "")
    columns = [F.col(f"`{c}`") for c in other.columns]
    right = right.select("__other", F.struct(*columns).alias("__row"))
    if repeats == "first":
        right = right.groupBy("__other").agg(F.min("__row").alias("__row"))
    asked = F.when(F.trim(F.col(key)) != "", F.col(key))
    # a hash of its own shuffles both sides for the join, so that hot keys are split at run time
    joined = left.withColumn("__asked", asked).withColumn("__hash", F.xxhash64("__asked")).join(
        right.withColumn("__own", F.xxhash64("__other")), (F.col("__hash") == F.col("__own")) & (F.col("__asked") == F.col("__other")), "left"
    )
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col("__row")[c].alias(c) for c in other.columns])
