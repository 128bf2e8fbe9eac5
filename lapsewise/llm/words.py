"""What counts as a word in every operator: a run of bytes other than blank and tab to carriage return."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(key: Column, seed: int | str) -> Column:
    """A number in [0, 1) that depends on the key and the seed only; a null key draws like an empty one."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def as_row(docs: DataFrame) -> DataFrame:
    """The rows as one column ``__row``, so that no name of theirs can clash with one of ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
