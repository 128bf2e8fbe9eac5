"""Removing text that repeats: every byte covered by a 50-byte string that starts in an earlier document too.

1. Whole copies. Of equal texts only the first goes on; the others are covered from end to end.
2. Candidates. Every window of 50 bytes has a key, the smallest hash of its 25-byte strings, so equal windows
   have equal keys. Neighbouring windows mostly share their key and form a chunk of some 13. Each task lists the keys of its documents, once each, in 6 bytes; a key that two documents have
   is sent back to the tasks that listed it, through one of their documents.
3. Chunks with such a key are written out: their place, and once for each task their bytes (again after ``SEEN``
   different ones, so that what a task remembers is bounded).
4. Suffix sorting. Chunks with the same key come together. Equal ones are collapsed to the first document that
   has them; the suffixes of different ones are sorted in two stages (:mod:`suffixes`) and the common
   prefixes of neighbours tell which windows are equal. Keys with more than ``CHUNKS`` chunks are not sorted
   in one task: their windows are grouped by their bytes.
5. A window is covered if its chunk occurs in an earlier document, or by 4. Covered bytes are removed.

Texts travel compressed, and are hashed in buffers that hold whole documents. What a task keeps is the keys of its documents; what
meets in one place is a row for each task or each different chunk, however many documents share it.

Defined cases: a null text is empty; null identifiers are larger than any other; rows with equal
identifiers do not remove each other's text; repeated rows all get the same result; an empty table gives
an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lapsewise.llm.suffixes import DEPTH, repeats
from lapsewise.sources.workspace import Scratch

GRAM = 25
BASE = 0x9E3779B97F4A7C15
BUFFER = 1 << 18
KEYS = 1 << 21
SORTED = 1 << 18
CHUNKS = 1 << 14
SEEN = 1 << 19
LAST = 2**63 - 1


def _hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place on."""
    powers = [pow(BASE, 1 << k, 1 << 64) for k in range(5)]
    level, total, at = data.astype(np.uint64) + np.uint64(1), None, 0
    for k in range(5):
        if GRAM >> k & 1:
            part = level[at:]
            total = part if total is None else total[: len(part)] * np.uint64(powers[k]) + part
            at += 1 << k
        level = level[: -(1 << k)] * np.uint64(powers[k]) + level[1 << k :]
    total = total[: len(data) - GRAM + 1]
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(29))


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of texts: number of the text, first window, number of windows (``DEPTH`` at most), key."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.empty(0, np.int64)
    if len(data) < DEPTH:
        return none, none, none, none.view(np.uint64)
    smallest, span = _hashes(data), 1
    while 2 * span <= DEPTH - GRAM + 1:
        smallest = np.minimum(smallest[:-span], smallest[span:])
        span *= 2
    rest = DEPTH - GRAM + 1 - span
    smallest = np.minimum(smallest[: len(smallest) - rest], smallest[rest:])
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), np.maximum(0, sizes - DEPTH + 1))
    first = np.cumsum(np.maximum(0, sizes - DEPTH + 1)) - np.maximum(0, sizes - DEPTH + 1)
    place = np.arange(len(owner)) - first[owner]  # windows within their text
    key = smallest[begins[owner] + place]
    if not len(key):
        return none, none, none, none.view(np.uint64)
    new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])))
    lengths = np.diff(np.append(new, len(key)))
    parts = -(-lengths // DEPTH)  # a text that repeats itself can have one key for long
    cut = np.repeat(new, parts) + DEPTH * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    windows = np.diff(np.append(cut, len(key)))
    return owner[cut], place[cut], windows, key[cut]


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows a few at a time, by the bytes of their texts."""
    for batch in batches:
        texts, start, size, unpack = batch.column("packed"), 0, 0, zstandard.ZstdDecompressor()
        part: list[bytes] = []
        for i, text in enumerate(texts):
            part.append(unpack.decompress(text.as_buffer()))
            size += len(part[-1])
            if size >= BUFFER or i + 1 == len(texts):
                yield batch.slice(start, i + 1 - start), part
                part, start, size = [], i + 1, 0


def _list_keys(ranges: int):
    def out(home: bytes, keys: list[np.ndarray], texts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Distinct keys by range, those of several texts twice."""
        key, text = np.concatenate(keys), np.concatenate(texts)
        order = np.argsort(key, kind="stable")
        key, text = key[order], text[order]
        same = key[1:] == key[:-1]
        several = np.unique(key[1:][same & (text[1:] != text[:-1])])
        key = np.sort(np.concatenate([key[np.append(True, ~same)], several]))
        to = (key % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        raw = key[order].view(np.uint8).reshape(-1, 8)[:, 2:]  # six bytes tell well enough
        ends = np.cumsum(np.bincount(to, minlength=ranges))
        used = [r for r in range(ranges) if ends[r] > (ends[r - 1] if r else 0)]
        blobs = [raw[ends[r - 1] if r else 0 : ends[r]].tobytes() for r in used]
        arrays = [pa.array(used, pa.int32()), pa.array([home] * len(used), pa.binary()), pa.array(blobs, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["range", "home", "keys"])

    def list_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, keys, texts, held, count = None, [], [], 0, 0
        for rows, data in _buffers(batches):
            home = home or rows.column("uid")[0].as_py()
            text, _, _, key = chunks(data)
            keys.append(key)
            texts.append(text + count)
            held, count = held + len(key), count + len(data)
            if held >= KEYS:
                yield from out(home, keys, texts)
                home, keys, texts, held = None, [], [], 0
        if held:
            yield from out(home, keys, texts)

    return list_keys


def _six(blob: bytes) -> np.ndarray:
    raw = np.zeros((len(blob) // 6, 8), np.uint8)
    raw[:, 2:] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return raw.view("<u8").ravel()


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each list of a range the keys that occur more than once in the range; lists come range by range."""

    def out(homes: list[bytes], lists: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, count = np.unique(np.concatenate(lists), return_counts=True)
        key = key[count > 1]
        found = [np.intersect1d(x, key) for x in lists]
        kept = [(h, f.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()) for h, f in zip(homes, found, strict=True) if len(f)]
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*kept, strict=True)], names=["home", "keys"])

    at, homes, lists = None, [], []
    for batch in batches:
        for place, home, blob in zip(*(batch.column(c).to_pylist() for c in ("range", "home", "keys")), strict=True):
            if place != at and lists:
                yield from out(homes, lists)
                homes, lists = [], []
            at = place
            homes.append(home)
            lists.append(_six(blob))
    if lists:
        yield from out(homes, lists)


def _write_chunks(most: int):
    def write_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of shared keys; their bytes where the task meets them first, or again after ``most`` others. Rows that bring keys come first."""
        shared, lists, seen = None, [], {}
        for rows, data in _buffers(batches):
            lists += [_six(b) for blobs in rows.column("keys").to_pylist() if blobs for b in blobs]
            if shared is None or lists:
                shared = np.unique(np.concatenate([*lists, *([shared] if shared is not None else []), np.empty(0, np.uint64)]))
                lists = []
            text, start, windows, key = chunks(data)
            short = key & ~np.uint64(0xFFFF)
            at = np.minimum(np.searchsorted(shared, short), max(0, len(shared) - 1))
            hit = shared[at] == short if len(shared) else np.zeros(len(key), bool)
            text, start, windows, key = text[hit], start[hit], windows[hit], key[hit]
            if not len(key):
                continue
            ids, raw = np.empty(len(key), np.uint64), []
            orders = rows.column("ord").to_numpy()[text].tolist()
            for i, (t, a, n, k, o) in enumerate(zip(text.tolist(), start.tolist(), windows.tolist(), key.tolist(), orders, strict=True)):
                content = data[t][a : a + n + DEPTH - 1]
                ids[i] = number = xxhash.xxh64_intdigest(content)
                before = seen.get((k, number))
                if before is None or o < before:  # rows come in order but for those that bring keys
                    if len(seen) >= most:
                        seen.clear()  # bytes written again meet their equals in the next step
                    seen[k, number] = o
                    raw.append(content)
                else:
                    raw.append(None)
            arrays = [
                pa.array(key.view(np.int64)), pa.array(ids.view(np.int64)), rows.column("ord").take(pa.array(text)), rows.column("uid").take(pa.array(text)),
                pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(raw, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "chunk", "ord", "uid", "start", "windows", "bytes"])

    return write_chunks


def _sort_suffixes(crowded: int):
    def masks_of(firsts: np.ndarray, sizes: np.ndarray, strings: list[bytes]) -> np.ndarray:
        """Masks of chunks that come key by key, ``sizes`` chunks a key; keys are sorted some at a time."""
        masks, low, at = np.zeros(len(firsts), np.uint64), 0, 0
        length = 0
        for end in np.cumsum(sizes).tolist():
            length += sum(map(len, strings[at:end]))
            at = end
            if length >= SORTED or end == len(strings):
                masks[low:end] = repeats(strings[low:end], firsts[low:end])
                low, length = end, 0
        return masks

    def out(key, chunk, first, mask, raw) -> pa.RecordBatch:
        raw = pa.nulls(len(key), pa.binary()) if raw is None else raw
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (key, chunk, first, mask)), raw], names=["key", "chunk", "first", "mask", "bytes"])

    def closed(key: np.ndarray, chunk: np.ndarray, order: np.ndarray, raw: pa.Array) -> pa.RecordBatch:
        """The first document of each chunk of these keys, and its windows that earlier documents have in other chunks."""
        new_key = np.append(True, key[1:] != key[:-1])
        begins = np.flatnonzero(new_key | np.append(True, chunk[1:] != chunk[:-1]))
        first = np.minimum.reduceat(order, begins)
        keys = np.flatnonzero(new_key[begins])
        sizes = np.diff(np.append(keys, len(begins)))
        several = np.flatnonzero(np.repeat(sizes, sizes) > 1)  # a chunk alone has nothing to compare with
        mask = np.zeros(len(begins), np.uint64)
        if len(several):
            mask[several] = masks_of(first[several], sizes[sizes > 1], raw.take(pa.array(begins[several])).to_pylist())
        return out(key[begins], chunk[begins], first, mask.view(np.int64), None)

    def sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``key, chunk, first, mask`` of chunks that come key by key; the rows of crowded keys with their bytes."""
        held, aside = None, None
        for batch in batches:
            batch = batch.select(["key", "chunk", "ord", "bytes"])
            held = batch if held is None else pa.concat_batches([held, batch])
            key = held.column(0).to_numpy()
            if aside is not None:
                n = int(np.searchsorted(key, aside, "right"))
                if n:
                    yield out(key[:n], held.column(1).slice(0, n), held.column(2).slice(0, n), np.zeros(n, np.int64), held.column(3).slice(0, n))
                held, key = held.slice(n), key[n:]
            if not len(key):
                continue
            n = int(np.searchsorted(key, key[-1], "left"))
            if n:
                yield closed(key[:n], *(held.column(i).slice(0, n).to_numpy() for i in (1, 2)), held.column(3).slice(0, n))
            held, key = held.slice(n), key[n:]
            if len(key) > crowded:
                aside = key[0]
                yield out(key, held.column(1), held.column(2), np.zeros(len(key), np.int64), held.column(3))
                held = None
        if held is not None and held.num_rows:
            yield closed(*(held.column(i).to_numpy() for i in range(3)), held.column(3))

    return sort_suffixes


def _group_windows(crowded: DataFrame) -> DataFrame:
    """``key, chunk, first, mask`` by grouping windows: rows of a crowded key stay spread."""
    chunks_ = crowded.groupBy("key", "chunk").agg(F.min("first").alias("first"), F.min("bytes").alias("bytes"))
    place = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - DEPTH))
    windows = chunks_.select("key", "chunk", "first", "bytes", place.alias("place"))
    windows = windows.select("key", "chunk", "first", "place", F.substring("bytes", F.col("place") + 1, DEPTH).alias("window"))
    smallest = windows.groupBy("window").agg(F.min("first").alias("smallest"))
    bit = F.when(F.col("smallest") < F.col("first"), F.expr("shiftleft(1L, place)")).otherwise(F.lit(0).cast("bigint"))
    return windows.join(smallest, "window").groupBy("key", "chunk", "first").agg(F.bit_or(bit).alias("mask"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = [pack.compress((t.as_py() or "").encode()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("ord"), pa.array(packed, pa.binary())], names=["uid", "ord", "packed"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans and kept bytes of texts from the places of their covered windows."""
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            part, spans, kept = batch.slice(low, 64), [], []
            for text, marks in zip(part.column("packed"), part.column("marks"), strict=True):
                data = np.frombuffer(zstandard.ZstdDecompressor().decompress(text.as_buffer()), np.uint8)
                start = np.array([m["start"] for m in marks.as_py()], np.int64)
                mask = np.array([m["mask"] for m in marks.as_py()], np.int64)
                rows, bits = np.nonzero(np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, start[rows] + bits, 1)
                np.add.at(change, start[rows] + bits + DEPTH, -1)
                gone = np.cumsum(change[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                kept.append(data[~gone].tobytes())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            arrays = [part.column("uid"), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["uid", "spans", "kept"])


def _identity(key: Column, sha: Column) -> Column:
    """Identifier and digest in 16 bytes: rows of the same identifier and text are alike."""
    return F.unhex(F.concat(F.lpad(F.hex(F.coalesce(key, F.lit(LAST))), 16, "0"), F.substring(sha, 1, 16)))


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Jobs planned inside have the setting."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def covered_windows(rows: DataFrame, scratch: Scratch, crowded: int = CHUNKS) -> DataFrame:
    """``uid, start, mask`` of the chunks with covered windows, from ``uid, ord, packed`` of different texts.

    Bit b of ``mask`` stands for the window that starts at byte ``start`` + b.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = rows.mapInArrow(_list_keys(parts), "range int, home binary, keys binary")
    listed = listed.repartition(parts, "range").sortWithinPartitions("range")
    shared = listed.mapInArrow(_shared_keys, "home binary, keys binary").groupBy("home").agg(F.collect_list("keys").alias("keys"))
    told = rows.join(shared, rows["uid"] == shared["home"], "left").sortWithinPartitions(F.col("keys").isNull(), "ord")
    kinds = "key bigint, chunk bigint, ord bigint, uid binary, start int, windows int, bytes binary"
    with _setting(spark, "spark.sql.adaptive.enabled", "false"):  # keys come back to the partition that listed them, as it was dealt
        found = scratch.store(told.select("uid", "ord", "packed", "keys").mapInArrow(_write_chunks(SEEN), kinds), "chunks")
    listed = found.where("bytes IS NOT NULL").select("key", "chunk", "ord", "bytes").repartition(parts, "key").sortWithinPartitions("key", "chunk")
    kinds = "key bigint, chunk bigint, first bigint, mask bigint, bytes binary"
    firsts = scratch.store(listed.mapInArrow(_sort_suffixes(crowded), kinds), "sorted")
    many = firsts.where("bytes IS NOT NULL")
    firsts = firsts.where("bytes IS NULL").drop("bytes")
    if not many.isEmpty():
        firsts = firsts.unionByName(scratch.store(_group_windows(many), "crowded"))
    every = F.when(F.col("windows") < 64, F.expr("shiftleft(1L, windows)") - 1).otherwise(F.lit(-1).cast("bigint"))
    mask = F.when(F.col("ord") > F.col("first"), every).otherwise(F.col("mask"))
    marked = found.drop("bytes").join(firsts, ["key", "chunk"]).select("uid", "start", mask.alias("mask"))
    return marked.where("mask != 0")


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", crowded: int = CHUNKS) -> DataFrame:
    """``doc_id, n_bytes, spans, kept, sha`` of every row: spans are removed byte ranges, ``kept`` the bytes left.

    ``kept`` is null where nothing was removed; ``sha`` is the digest of the whole text, in hex. The shuffle files of
    each job go when it ends, as all jobs here write tables that are read once more.
    """
    with _setting(docs.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        return _remove_repeats(docs, text, key, crowded)


def _remove_repeats(docs: DataFrame, text: str, key: str, crowded: int) -> DataFrame:
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "repeats")
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), plain.alias("text")).withColumn("sha", F.sha2("text", 256))
    rows = rows.withColumns({"uid": _identity(F.col("doc_id"), F.col("sha")), "ord": F.coalesce("doc_id", F.lit(LAST))})
    narrow = rows.select("uid", "doc_id", "ord", "sha", F.octet_length("text").cast("bigint").alias("n_bytes"))
    narrow = scratch.store(narrow, "rows")
    first = scratch.store(narrow.groupBy("sha").agg(F.min("ord").alias("first")), "first-of-equal")
    narrow = scratch.store(narrow.join(first, "sha").withColumn("copy", F.col("ord") > F.col("first")).drop("first", "ord"), "marked")
    copies = narrow.where("copy").select("uid").distinct()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = rows.select("uid", "ord", "text").mapInArrow(_pack, "uid binary, ord bigint, packed binary").repartition(parts, "uid")
    marks = covered_windows(texts.join(copies, "uid", "left_anti"), scratch, crowded)
    marks = scratch.store(marks.groupBy("uid").agg(F.collect_list(F.struct("start", "mask")).alias("marks")), "marks")
    scratch.drop("chunks", "sorted")
    kinds = "uid binary, spans array<struct<start:int,end:int>>, kept binary"
    cut = scratch.store(texts.join(marks, "uid").select("uid", "packed", "marks").mapInArrow(_cut, kinds), "cut")
    if not narrow.groupBy("uid").count().where("count > 1").isEmpty():  # rows repeated as a whole
        cut = cut.dropDuplicates(["uid"])
    whole = F.col("copy") & (F.col("n_bytes") >= DEPTH)
    end = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end")))
    spans = F.when(whole, end).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")))
    kept = F.when(whole, F.lit(b"")).otherwise(F.col("kept"))
    return narrow.join(cut, "uid", "left").select("doc_id", "n_bytes", spans.alias("spans"), kept.alias("kept"), "sha")


def repeat_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    found = remove_repeats(docs)
    left = F.coalesce(F.octet_length("kept").cast("bigint"), F.col("n_bytes"))
    digest = F.coalesce(F.sha2("kept", 256), F.col("sha"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - left).alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), digest.alias("kept_sha256")
    )
