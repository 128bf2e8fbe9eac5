"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram is the product
of its letters' vectors, each rolled by its place, and a text is the sum of its n-grams. Language
prototypes are the sums of the unit vectors of their texts; a text gets the language whose prototype
has the largest cosine, and the cosine, cut at 0, is the score.

Letters are the alphabetic characters of the lower-cased text; what lies between them is one blank.
Texts are cut into n-grams block by block, so the longest text needs no more memory than its distinct
n-grams. Prototypes are learned from about ``SAMPLE_ROWS`` texts of each language at most, drawn by a
hash of the identifier (the bound is on the expected number). They are all that reaches the driver, 2 KB for each
language, and ``GROUP_LANGUAGES`` languages at a time: a table with more of them is judged in several passes over
its texts, each of which keeps the better of its own language and the one found before.

Defined cases: a null text and one without a letter are ``und`` with score 0, and so is every text
when nothing could be learned; ties go to the language first by code point; null identifiers are not
held out and not learned from; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lapsewise.llm.words import uniform

DIMENSIONS = 512
NGRAM = 3
BLOCK = 1 << 20
GROUP = 64
TABLE_ROWS = 1 << 14
SAMPLE_ROWS = 2000
GROUP_LANGUAGES = 1000
HELD_OUT = (4, 2)
SEED = 4
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _alphabet() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(maxsize=4096)
def _letter(point: int) -> np.ndarray:
    bits = np.random.default_rng([SEED, point]).integers(0, 2, DIMENSIONS, dtype=np.int8)
    return bits * np.int8(2) - np.int8(1)


def _ngrams(codes: np.ndarray) -> np.ndarray:
    """One vector for each packed n-gram: the product of its letters' vectors, rolled by place."""
    product = np.ones((len(codes), DIMENSIONS), np.int8)
    for place in range(NGRAM):
        points, which = np.unique((codes >> (21 * place)) & 0x1FFFFF, return_inverse=True)
        product *= np.stack([np.roll(_letter(int(p)), place) for p in points])[which]
    return product


def count_ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Packed distinct n-grams of a text and how often each occurs; none where there is no letter."""
    counted, tail = [], np.array([32], np.int64)
    for start in range(0, len(text or ""), BLOCK):
        points = np.frombuffer(text[start : start + BLOCK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.concatenate([tail, np.where(_alphabet()[points], points, 32).astype(np.int64)])
        points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
        counted.append(np.unique(_packed(points), return_counts=True))
        tail = points[1 - NGRAM :]
    if tail[-1] != 32:
        counted.append(np.unique(_packed(np.append(tail, 32)), return_counts=True))
    counted = [c for c in counted if len(c[0])]
    if not counted:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, which = np.unique(np.concatenate([c for c, _ in counted]), return_inverse=True)
    return codes, np.bincount(which, np.concatenate([n for _, n in counted])).astype(np.int64)


def _packed(points: np.ndarray) -> np.ndarray:
    length = max(0, len(points) - NGRAM + 1)
    return sum((points[i : i + length] << (21 * i) for i in range(NGRAM)), np.zeros(length, np.int64))


class _Table:
    """Vectors of n-grams seen before in this process: ``TABLE_ROWS`` at most, then it starts anew."""

    def __init__(self) -> None:
        self.rows = np.empty((TABLE_ROWS, DIMENSIONS), np.float32)
        self.codes, self.slots = np.empty(0, np.int64), np.empty(0, np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Slots of ascending distinct codes, of which there are ``TABLE_ROWS`` at most."""
        at = np.minimum(np.searchsorted(self.codes, codes), max(0, len(self.codes) - 1))
        missing = codes[self.codes[at] != codes] if len(self.codes) else codes
        if len(missing):
            if len(self.codes) + len(missing) > TABLE_ROWS:
                self.codes, self.slots, missing = np.empty(0, np.int64), np.empty(0, np.int64), codes
            slots = np.arange(len(self.codes), len(self.codes) + len(missing))
            self.rows[slots] = _ngrams(missing)
            self.codes, self.slots = np.append(self.codes, missing), np.append(self.slots, slots)
            order = np.argsort(self.codes)
            self.codes, self.slots = self.codes[order], self.slots[order]
            at = np.searchsorted(self.codes, codes)
        return self.slots[at]


@lru_cache(maxsize=1)
def _table() -> _Table:
    return _Table()


def vectors(texts: list[str | None]) -> np.ndarray:
    """Unit vectors of texts, a row each; zero for a text without a letter."""
    table, bundles = _table(), np.zeros((len(texts), DIMENSIONS), np.float32)
    counts = [count_ngrams(t) for t in texts]
    every = np.unique(np.concatenate([c for c, _ in counts]))
    for low in range(0, len(every), TABLE_ROWS):
        part = every[low : low + TABLE_ROWS]
        slots = table.find(part)
        for row, (codes, n) in enumerate(counts):
            inside = (codes >= part[0]) & (codes <= part[-1])
            if inside.any():
                bundles[row] += n[inside].astype(np.float32) @ table.rows[slots[np.searchsorted(part, codes[inside])]]
    lengths = np.linalg.norm(bundles, axis=1, keepdims=True)
    return np.divide(bundles, lengths, out=np.zeros_like(bundles), where=lengths > 0)


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    texts = batch.column("text")
    for start in range(0, batch.num_rows, GROUP):
        yield start, vectors(texts.slice(start, GROUP).to_pylist())


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the unit vectors of each language that a task has seen."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = batch.column("lang").to_pylist()
        for start, units in _grouped(batch):
            for lang, unit in zip(languages[start:], units, strict=False):
                sums[lang] = sums.get(lang, 0) + unit.astype(np.float64)
    if sums:
        blobs = [v.tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_pydict({"lang": list(sums), "bundle": pa.array(blobs, pa.binary())})


def held_out(key: Column) -> Column:
    """Whether a document is kept from learning; a null identifier is not held out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % HELD_OUT[0] == HELD_OUT[1]


def learn(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, after: str | None = None
) -> tuple[dict[str, np.ndarray], str | None]:
    """Unit prototypes by language from ``doc_id, text, lang``, in the order of the languages.

    Of a table with many languages the first ``GROUP_LANGUAGES`` that come ``after`` the given one, with the name of
    the last of them; None where no more can follow.
    """
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known if after is None else known.where(F.col("lang") > after)
    sizes = known.groupBy("lang").count().orderBy("lang").limit(GROUP_LANGUAGES).collect()
    last = sizes[-1]["lang"] if len(sizes) == GROUP_LANGUAGES else None
    if not sizes:
        return {}, None
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, sample_rows / r["count"]))])
    sample = known.where(uniform(F.col("doc_id"), SEED) < share[F.col("lang")]).select("lang", "text")
    parts = sample.repartition(8).mapInArrow(_bundle, "lang string, bundle binary")  # 8 sums of a language at most
    sums: dict[str, np.ndarray] = {}
    for row in parts.toLocalIterator():
        sums[row["lang"]] = sums.get(row["lang"], 0) + np.frombuffer(row["bundle"])
    lengths = {k: np.linalg.norm(v) for k, v in sums.items()}
    return {k: (sums[k] / lengths[k]).astype(np.float32) for k in sorted(sums) if lengths[k] > 0}, last


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], columns: tuple[str, ...] = ()) -> DataFrame:
    """The ``columns`` of every row of ``docs`` with ``lang_pred`` and ``score``; reads ``text`` only."""
    names = pa.array([UNKNOWN, *prototypes], pa.string())
    known = np.stack([np.zeros(DIMENSIONS, np.float32), *prototypes.values()]).T

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for start, units in _grouped(batch):
                cosine = units @ known
                cosine[:, 0] = -2.0
                cosine[~units.any(axis=1), 0] = 2.0  # no letter
                at = slice(start, start + len(units))
                best[at] = cosine.argmax(axis=1)
                score[at] = np.where(best[at] > 0, np.clip(cosine.max(axis=1), 0.0, 1.0), 0.0)
            kept = [batch.column(c) for c in columns]
            arrays = [*kept, pa.array(names.take(pa.array(best))), pa.array(np.round(score, 5))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "lang_pred", "score"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    rows = docs.select(*columns, *([] if "text" in columns else ["text"]))
    return rows.mapInArrow(judge, f"{kinds + ', ' if kinds else ''}lang_pred string, score double")


def language_report(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row."""
    marked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    known = docs.select("doc_id", "text", "lang")
    prototypes, last = learn(known)
    if last is None:
        return predict(marked, prototypes, ("doc_id", "held_out"))
    best = marked.withColumns({"__pred": F.lit(UNKNOWN), "__score": F.lit(-1.0)})
    while True:
        judged = predict(best, prototypes, tuple(best.columns))
        better = (F.col("lang_pred") != UNKNOWN) & (F.col("score") > F.col("__score"))
        kept = {"__pred": F.when(better, F.col("lang_pred")).otherwise(F.col("__pred")), "__score": F.when(better, F.col("score")).otherwise(F.col("__score"))}
        best = judged.withColumns(kept).drop("lang_pred", "score")
        if last is None:
            break
        prototypes, last = learn(known, after=last)
    return best.select("doc_id", "held_out", F.col("__pred").alias("lang_pred"), F.greatest("__score", F.lit(0.0)).alias("score"))
