"""Exact deduplication as a stream with keyed state that never expires.

A store is a folder: ``content`` holds the documents that arrived, batch by batch, with digest and
identifier; ``state`` holds the stream's checkpoint. A streaming aggregation reads digest and identifier
of new content and keeps one entry per digest in a disk-backed (RocksDB) state store: the digest, the
smallest identifier, the locator of its row, and the number of rows. There is no watermark, so entries
stay for good; :func:`add_documents` on the same folder, in a later session too, goes on from them.
A locator is the content file and the position of the row in it, so it stays right for good and leads to
the bytes. Every task folds its own arrivals first, so of a group that holds a third of all rows one row
per task reaches the state. On hits (groups of two rows and more) the row that stays is told by its
locator, and the whole normalised bytes of each other row are compared with it; rows that differ in
spite of equal digests form groups of their own, by their bytes' own SHA-256.

A batch is written beside the content and renamed into it, so one that was cut short is never read; a
batch whose name is there already is not written again, so a call that is repeated counts its rows once.

Normalised: each run of blank, tab to carriage return becomes one space. Defined cases: a null
text counts as empty; a null identifier is larger than any other; of rows repeated with the
smallest identifier, in one batch or in several, the one with the smallest locator stays; an empty table
gives an empty result; other columns are carried along, whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from lapsewise.llm.words import GAP, as_row
from lapsewise.sources.workspace import Scratch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FILES_A_BATCH = 1000
LAST = 2**63 - 1


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " ")


def sha256(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def locator() -> list[Column]:
    """Where a content row is: its file, as ``batch/file``, and its position there."""
    return [F.substring_index("_metadata.file_path", "/", -2).alias("file"), F.col("_metadata.row_index").alias("place")]


def first_row(order: Column) -> list[Column]:
    """The smallest identifier of a group, the locator of its row, and the number of rows."""
    return [F.min(F.struct(order.alias("first_id"), "file", "place")).alias("first"), F.count(F.lit(1)).alias("group_size")]


def write_arrivals(
    docs: DataFrame, path: str, text: str, key: str, digest: Callable[[Column], Column], carried: tuple[str, ...] = (), batch: str | None = None
) -> None:
    """Add a batch of content: ``digest, id, sha, row``; the row has the text and the ``carried`` columns."""
    batch = batch or uuid.uuid4().hex
    if not re.fullmatch("[A-Za-z0-9][A-Za-z0-9_-]*", batch):
        raise ValueError(f"no name for a batch: {batch}")
    Path = docs.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, incoming = Path(f"{path}/{batch}"), Path(f"{path}-incoming/{batch}")
    system = target.getFileSystem(docs.sparkSession.sparkContext._jsc.hadoopConfiguration())
    if system.exists(target):
        return
    rows = as_row(docs).withColumn("plain", normalised(F.col(f"__row.`{text}`")))
    names = dict.fromkeys((text, *carried))
    rows = rows.select(
        digest(F.col("plain")).alias("digest"),
        F.col(f"__row.`{key}`").cast("bigint").alias("id"),
        sha256(F.col("plain")).alias("sha"),
        F.struct(*[F.col(f"__row.`{c}`") for c in names]).alias("row"),
    )
    rows.write.mode("overwrite").option("compression", "zstd").parquet(incoming.toString())
    system.mkdirs(target.getParent())
    if not system.rename(incoming, target):
        raise OSError(f"cannot rename {incoming.toString()}")


def read_content(spark: SparkSession, path: str, row: StructType | None = None) -> DataFrame:
    """``digest, id, sha, file, place`` of all content, and ``row`` with the given fields."""
    kinds = "digest binary, id bigint, sha binary"
    schema = StructType.fromDDL(kinds)
    if row is not None:
        schema = StructType([*schema, StructField("row", row)])
    return spark.read.schema(schema).parquet(f"{path}/*").select(*schema.names, *locator())


def state_session(spark: SparkSession) -> SparkSession:
    """A session of its own, since the state store is chosen by session settings.

    Without preallocated files a store of few entries takes kilobytes, however many partitions there are.
    """
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    return own


def run_stream(own: SparkSession, arrivals: str, state: str, files_a_batch: int = FILES_A_BATCH) -> None:
    """Take all arrivals not seen so far into the state at ``state``, however old; ends when none is left."""
    rows = own.readStream.schema("digest binary, id bigint").option("maxFilesPerTrigger", files_a_batch)
    rows = rows.option("maxFileAge", "36500d").parquet(f"{arrivals}/*").select("digest", "id", *locator())
    entries = rows.groupBy("digest").agg(*first_row(F.coalesce("id", F.lit(LAST))))
    writer = entries.writeStream.format("noop").outputMode("update").option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()


def read_state(own: SparkSession, state: str) -> DataFrame:
    """``digest, first_id, keep_file, keep_place, group_size``: all entries, read from the store itself."""
    entries = own.read.format("statestore").load(state)
    first, rows = (f"value.`{f.name}`" for f in entries.schema["value"].dataType.fields)
    return _entry(entries.select("key.digest", F.col(first).alias("first"), F.col(rows).alias("group_size")), "digest")


def _entry(groups: DataFrame, *by: str) -> DataFrame:
    keep = [F.col("first.first_id"), F.col("first.file").alias("keep_file"), F.col("first.place").alias("keep_place")]
    return groups.select(*by, *keep, "group_size")


def add_documents(
    docs: DataFrame,
    store: str,
    text: str = "text",
    key: str = "doc_id",
    digest: Callable[[Column], Column] = sha256,
    files_a_batch: int = FILES_A_BATCH,
    carried: tuple[str, ...] = (),
    batch: str | None = None,
) -> None:
    """Take documents into the store at the path ``store``, after all that came before."""
    write_arrivals(docs, f"{store}/content", text, key, digest, carried, batch)
    run_stream(state_session(docs.sparkSession), f"{store}/content", f"{store}/state", files_a_batch)


def _torn(spark: SparkSession, store: str, entries: DataFrame, scratch: Scratch, text: str) -> DataFrame:
    """The ``digest`` of each row whose bytes differ from those of the row that stays; repeats are left to the caller's joins.

    Nothing is counted by digest behind the join, so that Spark splits the hits of a hot digest at run time.
    """
    kind = StructType.fromDDL(f"`{text}` string")
    rows = read_content(spark, f"{store}/content", kind).select("digest", "file", "place", normalised(F.col(f"row.`{text}`")).alias("plain"))
    hits = rows.join(entries.where("group_size > 1").select("digest", "keep_file", "keep_place"), "digest")
    stay = (F.col("file") == F.col("keep_file")) & (F.col("place") == F.col("keep_place"))
    hits = scratch.store(hits.select("digest", "plain", stay.alias("stay")), "hits")
    stays = scratch.store(hits.where("stay").select("digest", F.col("plain").alias("stays")), "stays")
    torn = scratch.store(hits.where("NOT stay").join(stays, "digest").where("plain != stays").select("digest"), "torn")
    scratch.drop("hits", "stays")
    return torn


def groups(spark: SparkSession, store: str, scratch: Scratch, text: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """Entries of all digests whose rows have equal bytes, and those of the other digests by ``digest, sha``, if any."""
    entries = scratch.store(read_state(state_session(spark), f"{store}/state"), "entries")
    torn = _torn(spark, store, entries, scratch, text)
    if torn.isEmpty():
        return entries, None
    rows = read_content(spark, f"{store}/content").join(torn, "digest", "left_semi")
    split = _entry(rows.groupBy("digest", "sha").agg(*first_row(F.coalesce("id", F.lit(LAST)))), "digest", "sha")
    return scratch.store(entries.join(torn, "digest", "left_anti"), "whole"), scratch.store(split, "split")


def store_verdicts(spark: SparkSession, store: str, scratch: Scratch, text: str = "text") -> DataFrame:
    """One row per document that ever arrived: ``id, keep_id, group_size, kept, sha, digest, file, place``."""
    rows = read_content(spark, f"{store}/content")
    entries, split = groups(spark, store, scratch, text)
    marked = rows.join(entries, "digest")
    if split is not None:
        marked = marked.unionByName(rows.join(split, ["digest", "sha"]))
    kept = (F.col("file") == F.col("keep_file")) & (F.col("place") == F.col("keep_place"))
    keep_id = F.when(F.col("first_id") != LAST, F.col("first_id"))
    return marked.select("id", keep_id.alias("keep_id"), "group_size", kept.alias("kept"), "sha", "digest", "file", "place")


def verdicts(
    docs: DataFrame,
    scratch: Scratch,
    text: str = "text",
    key: str = "doc_id",
    digest: Callable[[Column], Column] = sha256,
    files_a_batch: int = FILES_A_BATCH,
) -> DataFrame:
    """One row per document, in a store that is made for this call."""
    add_documents(docs, scratch.path("store"), text, key, digest, files_a_batch)
    return store_verdicts(docs.sparkSession, scratch.path("store"), scratch, text)


def dedup_report(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row, dropped ones too."""
    marked = verdicts(docs, Scratch(docs.sparkSession, "dedup"))
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    return marked.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", sha)


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The rows that stay, in the columns they came with, fetched by their locators."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "dedup")
    store = scratch.path("store")
    add_documents(docs, store, text, key, digest, carried=tuple(docs.columns))
    entries, split = groups(spark, store, scratch, text)
    keep = entries.select("keep_file", "keep_place")
    if split is not None:
        keep = keep.unionByName(split.select("keep_file", "keep_place"))
    row = StructType([docs.schema[c] for c in dict.fromkeys((text, *docs.columns))])
    rows = read_content(spark, f"{store}/content", row)
    rows = rows.join(keep, (rows.file == keep.keep_file) & (rows.place == keep.keep_place), "left_semi")
    return rows.select(*[F.col(f"row.`{c}`") for c in docs.columns])
