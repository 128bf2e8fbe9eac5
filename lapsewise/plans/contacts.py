"""The contact history: everyone a new campaign must leave out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lapsewise import fixed_values as fv
from lapsewise.sources.files import recent_contacts, rolling_contacts
from lapsewise.sources.sinks import write_csv


def write_contact_history(
    lists: DataFrame, extraction: str, path: str, months: int = fv.HISTORY_MONTHS, extra: Sequence[DataFrame] = ()
) -> None:
    """Write the recent contact and control lists as one list of ids to exclude."""
    write_csv(recent_contacts(lists, extraction, months, extra), path)


def write_rolling_history(
    spark: SparkSession, lists: str, extraction: str, path: str, months: int = fv.HISTORY_MONTHS, extra: Sequence[DataFrame] = ()
) -> DataFrame:
    """Write the history from the stored lists below ``lists``; gives the report on their months."""
    history, report = rolling_contacts(spark, lists, extraction, months, extra)
    write_csv(history, path)
    return report
