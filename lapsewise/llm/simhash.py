"""Near-duplicate documents by SimHash fingerprints, linked through Golay codeword indices.

A fingerprint has 64 bits; bit b is 1 if it is 1 in over half the hashes of the document's
4-word shingles. Documents link when their fingerprints differ in 4 bits or fewer.

Candidates. A fingerprint is cut into segments of 22, 21 and 21 bits. The perfect Golay code (23, 12)
decodes any segment to the index of the one codeword within 3 bits. ``nearby`` of a segment are the
indices of all words within 1 bit of it (1 or 6 different ones). So

* segments that differ in 1 bit: each one's own index is among the other's nearby indices,
* segments that differ in 2 bits: they share a nearby index, that of the word half-way.

Four errors over three segments leave either a segment without error, and then another with 2 at
most: keys (segment as it is, nearby index of the other); or errors 1, 1 and 1 or 2: keys (own index,
nearby index, nearby index) and (nearby index, own index, nearby index), the third segment last.
Every linked pair meets under one of these keys of 33 to 36 bits; about 190 keys a fingerprint.

Links. Only different fingerprints travel. Rows are dealt and sorted by key, and each task reads its
buckets as a stream. In a bucket, distances are computed from one member to all not yet reached, so a
bucket gives a spanning set of verified links, never all its pairs. A bucket of more than ``BUCKET``
members is put aside, cut into blocks, and done pair of blocks by pair of blocks in tasks of their own.

Defined cases: a null text and one without words have fingerprint 0, linked like any other; a text of
fewer than 4 words is one shingle; null identifiers take part in groups but are no one's smallest; of
rows repeated with the smallest identifier one stays; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from lapsewise.llm.components import components
from lapsewise.llm.words import as_row
from lapsewise.sources.workspace import Scratch

SHINGLE = 4
SEED = 42
ERRORS = 4
WIDTHS = (22, 21, 21)
BUCKET = 1 << 16
CHUNK = 4096
BLOCK = 1 << 20
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
GENERATOR = 0b110001110101  # of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _words(text: str) -> Iterator[tuple[list[bytes], bool]]:
    """The words of a text, block by block, and whether the block is the last."""
    data, rest = text.encode().translate(LOWER), b""
    for start in range(0, len(data), BLOCK):
        piece, last = rest + data[start : start + BLOCK], start + BLOCK >= len(data)
        words, rest = piece.split(), b""
        if words and not last and not piece[-1:].isspace():
            rest = words.pop()
        yield words, last


def fingerprint(text: str | None) -> int:
    """The fingerprint as an unsigned number; 0 without words."""
    ones, total, kept = np.zeros(64, np.int64), 0, []
    for words, last in _words(text or ""):
        words = kept + words
        if len(words) >= SHINGLE:
            joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1) - 1
            starts = ends - lengths
            spans = zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
            hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans]
            kept = words[1 - SHINGLE :]
        else:
            hashes, kept = [], words
            if last and total == 0 and words:
                hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
        if hashes:
            bits = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


@pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def as_hex(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Check bits of the 4096 messages, and the error of each of the 2048 syndromes."""
    checks = np.arange(4096, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        checks ^= np.where((checks >> bit) & 1, GENERATOR << (bit - 11), 0)
    one = 1 << np.arange(23, dtype=np.int64)
    pairs = (one[:, None] | one[None, :]).ravel()
    triples = (pairs[:, None] | one[None, :]).ravel()
    errors = np.zeros(2048, np.int64)
    for few in (triples, pairs, one, np.zeros(1, np.int64)):  # fewer errors last
        errors[checks[few >> 11] ^ (few & 2047)] = few
    return checks, errors


def index(segments: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword within 3 bits of each 23-bit word."""
    checks, errors = _golay()
    return (segments ^ errors[checks[segments >> 11] ^ (segments & 2047)]) >> 11


def nearby(segments: np.ndarray, width: int) -> np.ndarray:
    """The different indices of all words within 1 bit of each segment: 6 columns, -1 where there are fewer."""
    flips = np.concatenate([[0], 1 << np.arange(width, dtype=np.int64)])
    found = np.sort(index(segments[:, None] ^ flips), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return np.sort(found, axis=1)[:, -6:]


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the fingerprints (unsigned), and for each the place of its fingerprint."""
    shifts = (WIDTHS[1] + WIDTHS[2], WIDTHS[2], 0)
    parts = [((prints >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in zip(shifts, WIDTHS, strict=True)]
    near, own = [nearby(p, w) for p, w in zip(parts, WIDTHS, strict=True)], [index(p) for p in parts]
    columns, tag = [], 0
    for i in range(3):
        for j in range(3):
            if i != j:
                columns.append(np.where(near[j] < 0, -1, (tag << 40) | (parts[i][:, None] << 12) | near[j]))
                tag += 1
    for third in range(3):
        i, j = (x for x in range(3) if x != third)
        for a, b in ((own[i][:, None], near[j]), (near[i], own[j][:, None])):
            pair = np.where((a < 0) | (b < 0), -1, (a << 12) | b)
            if a is near[i]:  # what the other order has as well
                pair = np.where(a == own[i][:, None], -1, pair)
            triple = (pair[:, :, None] << 12) | near[third][:, None, :]
            bad = (pair[:, :, None] < 0) | (near[third][:, None, :] < 0)
            columns.append(np.where(bad, -1, (tag << 40) | triple).reshape(len(prints), -1))
        tag += 1
    table = np.concatenate(columns, axis=1)
    rows, at = np.nonzero(table >= 0)
    return table[rows, at], rows


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            prints = batch.column(0).slice(start, CHUNK).to_numpy()
            found, rows = keys(prints.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(prints[rows])], names=["key", "print"])


def spanning_links(prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what is joined by distances of ``ERRORS`` or fewer among the (signed) fingerprints."""
    left, links = np.unique(prints), []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= ERRORS
            if near.any():
                front.extend(left[near])
                links.extend((int(at), int(x)) for x in left[near])
                left = left[~near]
    return links


def _linker(bucket: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of the buckets, read in the order of their keys; members of too large ones with their key."""

        def out(key, u, v) -> pa.RecordBatch:
            key = pa.array(key, pa.int64()) if key is not None else pa.nulls(len(u), pa.int64())
            return pa.RecordBatch.from_arrays([key, pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["key", "u", "v"])

        def closed(key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            same = key[1:] == key[:-1]
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            sizes = np.diff(np.append(first, len(key)))
            two = first[sizes == 2]
            two = two[np.bitwise_count((prints[two] ^ prints[two + 1]).view(np.uint64)) <= ERRORS]
            more = [spanning_links(prints[a : a + n]) for a, n in zip(first[sizes > 2], sizes[sizes > 2], strict=True)]
            more = np.array([x for links in more for x in links], np.int64).reshape(-1, 2)
            return out(None, np.append(prints[two], more[:, 0]), np.append(prints[two + 1], more[:, 1]))

        key, prints, aside = np.empty(0, np.int64), np.empty(0, np.int64), None
        for batch in batches:
            key = np.append(key, batch.column(0).to_numpy())
            prints = np.append(prints, batch.column(1).to_numpy())
            if aside is not None:
                n = int(np.searchsorted(key, aside, "right"))
                if n:
                    yield out(key[:n], prints[:n], prints[:n])
                key, prints = key[n:], prints[n:]
            if not len(key):
                continue
            n = int(np.searchsorted(key, key[-1], "left"))
            if n:
                yield closed(key[:n], prints[:n])
            key, prints = key[n:], prints[n:]
            if len(key) > bucket:
                aside = key[0]
                yield out(key, prints, prints)
                key, prints = key[:0], prints[:0]
        if len(key):
            yield closed(key, prints)

    return link


def links(prints: DataFrame, scratch: Scratch, bucket: int = BUCKET) -> DataFrame:
    """``u, v``: verified links that join the different fingerprints ``print`` into their classes."""
    rows = prints.select("print").mapInArrow(_spread, "key bigint, print bigint")
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "key").sortWithinPartitions("key")
    found = scratch.store(dealt.mapInArrow(_linker(bucket), "key bigint, u bigint, v bigint"), "bucket-links")
    direct, large = found.where("key IS NULL").select("u", "v"), found.where("key IS NOT NULL")
    if large.isEmpty():
        return direct
    blocks = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / (bucket // 2)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("u"), F.col("blocks"))
    members = large.join(scratch.store(blocks, "blocks"), "key").withColumn("own", own)
    others = members.select("key", "u", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    task = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    pairs = others.select(task.alias("key"), F.col("u").alias("print")).repartition(parts, "key").sortWithinPartitions("key")
    return direct.unionByName(pairs.mapInArrow(_linker(1 << 62), "key bigint, u bigint, v bigint").select("u", "v"))


def classes(prints: DataFrame, scratch: Scratch, bucket: int = BUCKET) -> DataFrame:
    """``print, root, component_id`` of every fingerprint in ``doc_id, print``: its class, and the smallest doc_id in it."""
    each = scratch.store(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "prints")
    return rooted_classes(each, components(links(each, scratch, bucket), scratch), scratch)


def rooted_classes(each: DataFrame, joined: DataFrame, scratch: Scratch) -> DataFrame:
    """``print, root, component_id`` of every ``print, first``, by the components ``node, component``."""
    rooted = each.join(joined.withColumnRenamed("node", "print"), "print", "left")
    rooted = scratch.store(rooted.withColumn("root", F.coalesce("component", "print")).drop("component"), "rooted")
    roots = scratch.store(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "roots")
    return scratch.store(rooted.join(roots, "root").select("print", "root", "component_id"), "classes")


def near_dup_report(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.store(docs.select("doc_id", fingerprints("text").alias("print")), "documents")
    marked = prints.join(classes(prints, scratch), "print")
    return marked.select("doc_id", as_hex(F.col("print")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of each group, that with the smallest identifier, in the columns they came with."""
    scratch = Scratch(docs.sparkSession, "simhash")
    row = as_row(docs)
    named = row.select(F.col(f"__row.{key}").alias("doc_id"), fingerprints(f"__row.{text}").alias("print"))
    prints = scratch.store(named, "documents")
    return smallest(row, prints, classes(prints, scratch), fingerprints, scratch, text, key)


def smallest(row: DataFrame, prints: DataFrame, classes_: DataFrame, print_of: Callable, scratch: Scratch, text: str, key: str) -> DataFrame:
    """Of each class the row with the smallest identifier, from ``__row`` and the ``doc_id, print`` of all rows."""
    stays = prints.join(classes_, "print").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # of rows with the smallest identifier of their class one fingerprint, should the identifier be repeated
    stays = stays.groupBy("root").agg(F.min("print").alias("print"), F.first("doc_id").alias("__id"))
    stays = scratch.store(stays, "stays")
    found = row.join(stays, F.col(f"__row.{key}").eqNullSafe(F.col("__id")))
    repeated = prints.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return found.select("__row.*")
    repeated = scratch.store(repeated.withColumnRenamed("doc_id", "__again"), "repeated")
    again = F.col("__id").eqNullSafe(F.col("__again"))
    once = found.join(repeated, again, "left_anti").select("__row")
    more = found.join(repeated, again, "left_semi").where(print_of(f"__row.{text}") == F.col("print"))
    return once.unionByName(more.groupBy("root").agg(F.any_value("__row").alias("__row")).select("__row")).select("__row.*")
