"""File sources. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lapsewise import fixed_values as fv
from lapsewise.functions.dates import check_day, day
from lapsewise.operators.snapshots import union_all
from lapsewise.sources.manifest import data_files
from lapsewise.sources.workspace import stored

CONTACT_SCHEMA = "NOGPA string, note_fragilite int"
HISTORY_SCHEMA = "identifiantrce string, note_fragilite int"
ADVISOR_SCHEMA = "`Nom` string, `Prénom` string, `Adresse mail` string"


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """Delimited file with a header."""
    return spark.read.schema(schema).csv(path, sep=sep, encoding=encoding, header=True)


def read_advisors(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, ADVISOR_SCHEMA, sep=";").select(
        F.col("Nom").alias("cc_nom"), F.col("`Prénom`").alias("cc_prenom"), F.col("`Adresse mail`").alias("email")
    )


def read_frame(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A frame written before as parquet."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_contact_lists(spark: SparkSession, path: str) -> DataFrame:
    """Contact and control lists written by campaign, role and month end."""
    schema = f"{CONTACT_SCHEMA}, campaign string, role string, month_end date"
    return spark.read.schema(schema).option("header", True).option("basePath", path).csv(path)


def month_ends(extraction: str, months: int = fv.HISTORY_MONTHS) -> list[date]:
    """Last days of the month of the extraction and of those before it, the latest first."""
    at = datetime.strptime(check_day(extraction), "%Y%m%d").date()
    found = []
    for _ in range(months):
        end = (at.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)
        found.append(end)
        at = end.replace(day=1) - timedelta(days=1)
    return found


def list_months(spark: SparkSession, path: str, ends: Sequence[date]) -> dict[date, tuple[str, list[str]]]:
    """State of each month's lists below ``path`` and their files: ``present``, ``missing`` or ``unreadable``.

    A month without folder or without data files is missing; one of whose files cannot be opened is unreadable.
    Both are listed through Hadoop's file system, so the folder may be on any store that Spark reads.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    system = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
    found = {}
    for end in ends:
        folders = system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/campaign=*/role=*/month_end={end}")) or []
        files = [file for folder in folders for file in data_files(spark, folder.getPath().toString())]
        state = "present" if files else "missing"
        for file in files:
            try:
                system.open(jvm.org.apache.hadoop.fs.Path(file)).close()
            except Py4JJavaError:
                state = "unreadable"
        found[end] = (state, files)
    return found


def rolling_contacts(
    spark: SparkSession, path: str, extraction: str, months: int = fv.HISTORY_MONTHS, extra: Sequence[DataFrame] = ()
) -> tuple[DataFrame, DataFrame]:
    """Everyone on a stored list of the last months, and a report ``month_end, state, files, rows, malformed``.

    Missing months are passed over, as a list may not have been made; an unreadable one is an error, since its people
    would be contacted again. Of a malformed line the id still counts where it has one; the report says how many
    lines were malformed.
    """
    found = list_months(spark, path, month_ends(extraction, months))
    bad = [str(end) for end, (state, _) in found.items() if state == "unreadable"]
    if bad:
        raise OSError(f"contact lists cannot be read: {', '.join(bad)}")
    files = [file for _, listed in found.values() for file in listed]
    schema = f"{CONTACT_SCHEMA}, _corrupt_record string"
    if files:
        reader = spark.read.schema(schema).option("header", True).option("basePath", path).option("mode", "PERMISSIVE")
        # parsed once: malformed lines are only known where whole lines are parsed
        lines = stored(reader.csv(files).withColumn("month_end", F.col("month_end").cast("date")), "lines")
    else:
        lines = spark.createDataFrame([], f"{schema}, campaign string, role string, month_end date")
    counted = lines.groupBy("month_end").agg(
        F.count(F.lit(1)).alias("rows"), F.count("_corrupt_record").alias("malformed")
    )
    states = spark.createDataFrame(
        [(end, state, len(listed)) for end, (state, listed) in found.items()], "month_end date, state string, files int"
    )
    report = states.join(counted, "month_end", "left").fillna(0, ["rows", "malformed"])
    return recent_contacts(lines.where("NOGPA is not null"), extraction, months, extra), report


def recent_contacts(
    lists: DataFrame, extraction: str, months: int = fv.HISTORY_MONTHS, extra: Sequence[DataFrame] = ()
) -> DataFrame:
    """Everyone on a list of the last ``months`` month ends, and on the extra lists.

    Repeats stay, as the lists have them; the exclusion join does not mind.
    """
    extracted = day(check_day(extraction))
    month_end = F.col("month_end")
    recent = lists.where(
        (month_end >= F.last_day(F.add_months(extracted, 1 - months)))
        & (month_end <= F.last_day(extracted))
        & (month_end == F.last_day(month_end))
    )
    frames = [f.select(F.col("NOGPA").alias("identifiantrce"), "note_fragilite") for f in (recent, *extra)]
    return union_all(lists.sparkSession, frames, StructType.fromDDL(HISTORY_SCHEMA))
