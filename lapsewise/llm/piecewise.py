"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of ``WINDOW`` code points decides where a chunk ends, so an edit moves no boundary but those near
it. A chunk ends where the last k bits of the hash are ones; 2^k is the block size, the smallest with which
``CHUNKS`` blocks hold the text. A signature is a list of symbols, each the lowest 12 bits of the hash of a chunk and
the window before it, written as two characters. A fingerprint is the block size, the signature at that size and the
one at twice the size: ``8:...:...``.

Two fingerprints are compared where their block sizes meet, by the edit distance of the signatures in which a symbol
is put in or taken out: likeness 1 - distance / (sum of the lengths), 0 where no block size meets, 1 for equal
fingerprints. A text of half the length has half or the same block size at least, so it still compares.

``with_next`` deals the documents by ranges of their identifier and reads each range in order, so that a document
meets the next one in the task; the first and the last document of each range meet in a second step of as many rows
as there are ranges. Nothing else travels.

Defined cases: a null text is empty; the fingerprint of an empty text is ``1::``; null identifiers come last; rows with
equal identifiers follow one another in the order of their texts; a single document is its own next one; an empty
table gives an empty result; other columns are left out. A signature has ``LONGEST`` symbols at most (texts of
one repeated passage may have more chunks): the last one then stands for all the rest of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType

from lapsewise.sources.workspace import Scratch

WINDOW = 7
CHUNKS, LONGEST = 64, 128
FACTOR = 0x01000193
SEED = 12
BLOCK = 1 << 20
OUT = 1 << 12
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
SYMBOLS = [a + b for a in LETTERS for b in LETTERS]
RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
LINKED = f"range int, kind string, text string, {RESULT}"


class Print(NamedTuple):
    """Block size, and the symbols at that size and at twice the size."""

    block: int
    once: list[int]
    twice: list[int]

    def __str__(self) -> str:
        return f"{self.block}:{''.join(SYMBOLS[s] for s in self.once)}:{''.join(SYMBOLS[s] for s in self.twice)}"


def _rolled(points: np.ndarray) -> np.ndarray:
    """Mixed hash of the ``WINDOW`` code points that end at each place; nothing stands before the text."""
    total = points.copy()
    for j in range(1, min(WINDOW, len(points))):
        total[j:] += points[:-j] * np.uint32(pow(FACTOR, j, 1 << 32))
    total ^= total >> np.uint32(15)
    total *= np.uint32(0x85EBCA6B)
    total ^= total >> np.uint32(13)
    total *= np.uint32(0xC2B2AE35)
    return total ^ (total >> np.uint32(16))


def _ends(points: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks at the block size and at twice the size, without the end of the text."""
    found = []
    for start in range(0, len(points), BLOCK):
        before = min(start, WINDOW - 1)
        rolled = _rolled(points[start - before : start + BLOCK])[before:]
        for mask in (block - 1, 2 * block - 1):
            found.append(start + 1 + np.flatnonzero((rolled & np.uint32(mask)) == np.uint32(mask)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found[::2]), np.concatenate(found[1::2])


def print_of(text: str | None) -> Print:
    data = (text or "").encode("utf-32-le", "surrogatepass")
    points, block = np.frombuffer(data, np.uint32), 1
    while CHUNKS * block < len(points):
        block *= 2
    signatures, view = [], memoryview(data)
    for ends in _ends(points, block):
        cuts = [0, *(e for e in ends[: LONGEST - 1].tolist() if e < len(points)), len(points)] if len(points) else []
        chunks = zip(cuts, cuts[1:])
        signatures.append([xxhash.xxh64_intdigest(view[4 * max(0, a - WINDOW + 1) : 4 * b], SEED) & 4095 for a, b in chunks])
    return Print(block, *signatures)


def fingerprint(text: str | None) -> str:
    return str(print_of(text))


def _common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit for each symbol of ``a``."""
    places: dict[int, int] = {}
    for i, symbol in enumerate(a):
        places[symbol] = places.get(symbol, 0) | 1 << i
    full = open_ = (1 << len(a)) - 1
    for symbol in b:
        hit = open_ & places.get(symbol, 0)
        if hit:
            open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


def _alike(a: list[int], b: list[int]) -> float:
    return 2 * _common(a, b) / (len(a) + len(b)) if a or b else 0.0


def likeness_of(a: Print, b: Print) -> float:
    """0 to 1: one less the edit distance of the signatures, as a share of their lengths."""
    if a == b:
        return 1.0
    if a.block == b.block:
        return max(_alike(a.once, b.once), _alike(a.twice, b.twice))
    if a.block == 2 * b.block:
        return _alike(a.once, b.twice)
    return _alike(a.twice, b.once) if 2 * a.block == b.block else 0.0


def parse(text: str) -> Print:
    block, *signatures = text.split(":")
    place = {c: i for i, c in enumerate(LETTERS)}
    return Print(int(block), *[[64 * place[a] + place[b] for a, b in zip(s[::2], s[1::2], strict=True)] for s in signatures])


@pandas_udf(StringType())
def fingerprints(texts: pd.Series) -> pd.Series:
    """Fingerprint of each text."""
    return pd.Series([fingerprint(t) for t in texts], dtype=object)


@pandas_udf(DoubleType())
def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    """Likeness of two fingerprints; null where one is null."""
    return pd.Series([None if x is None or y is None else likeness_of(parse(x), parse(y)) for x, y in zip(a, b)], dtype="float64")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(key: int | None, text: str, own: Print, following: str, other: Print) -> tuple:
    new = edited(text, following)
    changed = own if new == text else print_of(new)
    digest = hashlib.sha256(new.encode()).hexdigest()
    return key, len(text), digest, str(own), str(changed), likeness_of(own, changed), likeness_of(own, other)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [(c, pa.float64()) for c in ("near_edited", "near_next")]
)
_LINKED = pa.schema([("range", pa.int32()), ("kind", pa.string()), ("text", pa.string()), *_RESULT])


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each document of a range with the next; hand on the first and the last with their texts."""
    place, last, rows = TaskContext.get().partitionId(), None, []
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            key, text = key.as_py(), text.as_py()
            own = print_of(text)
            if last is None:
                rows.append((place, "first", text, key, *[None] * 6))
            else:
                rows.append((place, "row", None, *_compared(*last, text, own)))
            last = key, text, own
            if len(rows) == OUT:
                yield _batch(rows, _LINKED)
                rows = []
    if last is not None:
        rows.append((place, "last", last[1], last[0], *[None] * 6))
        yield _batch(rows, _LINKED)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            key, text, following = (batch.column(c)[i].as_py() for c in ("doc_id", "text", "following"))
            yield _batch([_compared(key, text, print_of(text), following, print_of(following))], _RESULT)


def with_next(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness to each other and to the next document's.

    The next document has the next smaller identifier; after the smallest comes the greatest.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "piecewise")
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    falling = F.col("doc_id").desc_nulls_last()
    linked = rows.repartitionByRange(falling).sortWithinPartitions(falling, "text").mapInArrow(_link, LINKED)
    linked = scratch.store(linked, "linked")
    # a number for each range that has rows
    places = sorted(r["range"] for r in linked.where("kind = 'first'").select("range").collect())
    follows = list(zip(places, places[1:] + places[:1], strict=True))
    follows = spark.createDataFrame(follows, "range int, next int")
    first = linked.where("kind = 'first'").select(F.col("range").alias("next"), F.col("text").alias("following"))
    last = linked.where("kind = 'last'").select("range", "doc_id", "text").join(F.broadcast(follows), "range").join(first, "next")
    ends = last.select("doc_id", "text", "following").mapInArrow(_close, RESULT)
    return linked.where("kind = 'row'").select(*_RESULT.names).unionByName(ends)


def fingerprint_report(docs: DataFrame) -> DataFrame:
    return with_next(docs)
