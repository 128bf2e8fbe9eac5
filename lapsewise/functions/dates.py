"""Date expressions. Months are ``yyyyMM`` text in outputs and month numbers inside."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lapsewise import fixed_values as fv


def month_key(when: Column) -> Column:
    return F.date_format(when, "yyyyMM")


def month_number(when: Column) -> Column:
    """Months since year 0, so that consecutive months differ by one."""
    return F.year(when) * 12 + F.month(when) - 1


def month_number_of(yyyymm: str) -> int:
    return int(yyyymm[:4]) * 12 + int(yyyymm[4:6]) - 1


def month_key_of_number(number: Column) -> Column:
    year = F.floor(number / 12)
    return F.concat(
        F.lpad(year.cast("string"), 4, "0"), F.lpad((F.pmod(number, F.lit(12)) + 1).cast("string"), 2, "0")
    )


def month_start(yyyymm: Column | str) -> Column:
    text = F.lit(yyyymm) if isinstance(yyyymm, str) else yyyymm
    return F.to_date(text, "yyyyMM")


def day(yyyymmdd: Column | str) -> Column:
    text = F.lit(yyyymmdd) if isinstance(yyyymmdd, str) else yyyymmdd
    return F.to_date(text, "yyyyMMdd")


def month_name(yyyymm: Column) -> Column:
    return F.date_format(month_start(yyyymm), "MMM")


def month_starts(first: Column, count: int) -> Column:
    """``count`` consecutive ``yyyyMM01`` texts from the month of ``first``."""
    start = F.trunc(first, "MM")
    days = F.sequence(start, F.add_months(start, count - 1), F.expr("interval 1 month"))
    return F.transform(days, lambda d: F.date_format(d, "yyyyMMdd"))


def quarter_calendar(spark: SparkSession, quarters: int = 24) -> DataFrame:
    """``(month_id, date_ref)`` quarter ends; month 12 is December 2016."""
    end = F.last_day(F.add_months(F.lit("2016-12-01").cast("date"), (F.col("id") * 3).cast("int")))
    return spark.range(quarters).select(
        (F.col("id") * 3 + 12).cast("int").alias("month_id"), F.date_format(end, "yyyyMMdd").alias("date_ref")
    )


def add_month_id(
    df: DataFrame, date_ref: str = "date_ref", out: str = "month_id", last: str | None = None
) -> DataFrame:
    """Month number of a ``yyyyMMdd`` quarter end as text, '' for any other date.

    Counted from December 2016, which is 12, to ``last`` (``yyyyMMdd``) or without an end.
    """
    text = F.col(date_ref)
    when = F.when(is_day_text(text), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))
    number = month_number(when) - month_number_of("201612") + 12
    known = (number >= 12) & (number % 3 == 0) & (when == F.last_day(when))
    if last:
        known = known & (text <= last)
    return df.withColumn(out, F.coalesce(F.when(known, number.cast("string")), F.lit("")))


def is_month_text(value: Column) -> Column:
    """yyyymm; the month may have one digit. NULL is not valid."""
    return F.coalesce(value.rlike(r"^(?!0000)[0-9]{4}(1[0-2]|0?[1-9])$"), F.lit(False))


def is_day_text(value: Column) -> Column:
    """yyyymmdd of exactly eight digits naming a real day. NULL is not valid."""
    real = F.try_to_timestamp(value, F.lit("yyyyMMdd")).isNotNull()
    return F.coalesce(value.rlike("^(?!0000)[0-9]{8}$") & real, F.lit(False))


def check_month(value: str | None) -> str:
    """The argument itself when it is a yyyymm month of six digits, else ``ValueError``."""
    try:
        if len(value) != 6:
            raise ValueError
        datetime.strptime(value, "%Y%m")
    except (TypeError, ValueError):
        raise ValueError(f"not a yyyymm month: {value!r}") from None
    return value


def check_day(value: str | None) -> str:
    """The argument itself when it is a yyyymmdd day, else ``ValueError``."""
    try:
        if len(value) != 8:
            raise ValueError
        datetime.strptime(value, "%Y%m%d")
    except (TypeError, ValueError):
        raise ValueError(f"not a yyyymmdd day: {value!r}") from None
    return value


def campaign_name(when: Column, week: Column, prefix: str = fv.CAMPAIGN_PREFIX) -> Column:
    """Prefix, year of the following month, and the week on two digits."""
    from lapsewise.functions.text import zero_fill

    year = F.year(F.add_months(when, 1)).cast("string")
    return F.concat(F.lit(prefix), year, F.lit(" - S"), zero_fill(week, 2))
