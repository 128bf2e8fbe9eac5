"""Near copies by the Jaccard similarity of word shingles: candidates by SimHash fingerprints, then MinHash bands; links verified exactly.

Documents link when the sets of their 5-word shingles (ASCII letters in lower case) have a similarity of
0.8 or more. Equal sets are one. The first candidates are those of ``simhash``: texts whose fingerprints are
equal, or linked through their Golay codeword indices. Fingerprints of sets at 0.8 differ in about 10 of 64 bits, more
than those links reach, so each set also has ``BANDS`` keys, each of ``ROWS`` minima of its hashes; two
sets of similarity s share none with probability (1 - s^5)^32, which is 0.000003 at 0.8 and less above.
That is the only loss, for pairs the fingerprints miss too: every pair that shares a key is verified on the whole sets or
already joined by verified links.

Links. A large group of copies shares most keys, so links are found in rounds: first by the fingerprints and by neighbours
within the buckets of a few bands, then neighbours among the groups found so far within all buckets. What is left are buckets
in which several groups still meet. Their members go to a task with their whole sets, and each is compared there
with all not yet reached, so that a bucket gives a spanning set of verified links and no pair is ever written. A bucket of
more than ``HELD`` hashes is cut into blocks, and done pair of blocks by pair of blocks in tasks of their own.

Defined cases: texts without words are equal to one another and like no other; a text of fewer than 5 words
is one shingle; ids as in ``simhash``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from lapsewise.llm import simhash
from lapsewise.llm.components import components
from lapsewise.llm.words import as_row
from lapsewise.sources.workspace import Scratch

SHINGLE = 5
BANDS, ROWS = 32, 5
FIRST_BANDS = 4
SEED = 43
CHUNK = 1024
HELD = 1 << 21  # hashes of a bucket that one task compares at once
LINKS = "u string, v string"
SKETCH = StructType().add("print", StringType()).add("n", LongType()).add("keys", ArrayType(LongType()))
_random = np.random.default_rng(SEED)
FACTORS = _random.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted different hashes of the shingles."""
    hashes, kept = [], []
    for words, last in simhash._words(text or ""):
        words = kept + words
        if len(words) >= SHINGLE:
            joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1) - 1
            starts = ends - lengths
            spans = zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
            hashes += [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans]
            kept = words[1 - SHINGLE :]
        else:
            kept = words
            if last and not hashes and words:
                hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    return np.unique(np.array(hashes, np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band; none for an empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), CHUNK):
        least = np.minimum(least, (hashes[start : start + CHUNK, None] * FACTORS + SHIFTS).min(axis=0))
    keys = [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64)


def _print(hashes: np.ndarray) -> str:
    """128 bits that stand for the set."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).hexdigest()


@pandas_udf(SKETCH)
def sketches(texts: pd.Series) -> pd.DataFrame:
    sets = [(_print(s), len(s), band_keys(s)) for s in map(shingle_set, texts)]
    return pd.DataFrame(sets, columns=["print", "n", "keys"])


@pandas_udf(StringType())
def prints_of(texts: pd.Series) -> pd.Series:
    return pd.Series([_print(shingle_set(t)) for t in texts], dtype=object)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            sets = [shingle_set(t.as_py()) for t in batch.column(0).slice(start, 256)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_print(s) for s in sets], pa.string()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["print", "hashes"]
            )


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets have a similarity of 0.8 or more."""
    return 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c) for c in ("a", "b")]
        good = [similar(*(np.frombuffer(c[i].as_buffer(), np.uint64) for c in columns)) for i in range(batch.num_rows)]
        yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))


def _alike(a: str, b: str) -> Column:
    return F.least(a, b) * 5 >= F.greatest(a, b) * 4


def _grouped(members: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of buckets in which several groups meet, with their group."""
    joined = components(links, scratch)
    rows = members.join(joined.withColumnRenamed("node", "print"), "print", "left").withColumn("group", F.coalesce("component", "print")).drop("component")
    rows = scratch.store(rows, "rows")
    mixed = rows.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("key")
    return scratch.store(rows.join(scratch.store(mixed, "mixed"), "key", "left_semi"), "open")


def _neighbours(members: DataFrame) -> DataFrame:
    order = Window.partitionBy("key").orderBy("print")
    after = members.select(F.col("print").alias("u"), F.lead("print").over(order).alias("v"), F.col("n"), F.lead("n").over(order).alias("m"))
    return after.where(F.col("v").isNotNull() & _alike("n", "m")).select("u", "v").distinct()


def _fingerprint_pairs(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """Sets of one fingerprint as a chain, and one set of each of two linked fingerprints, where their sizes allow a link."""
    marked = scratch.store(prints.where("n > 0").select(F.col("fingerprint").alias("key"), "print", "n").distinct(), "sets")
    one = marked.groupBy("key").agg(F.min(F.struct("print", "n")).alias("one"))
    one = scratch.store(one.select("key", "one.print", "one.n"), "one")
    linked = scratch.store(simhash.links(one.select(F.col("key").alias("print")), scratch), "links")
    a = one.select(F.col("key").alias("u"), F.col("print").alias("a"), "n")
    b = one.select(F.col("key").alias("v"), F.col("print").alias("b"), F.col("n").alias("m"))
    across = linked.join(a, "u").join(b, "v").where((F.col("a") != F.col("b")) & _alike("n", "m"))
    across = across.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
    return _neighbours(marked).unionByName(across).distinct()


def spanning_links(prints: list[str], groups: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> list[tuple[str, str]]:
    """Links of similar sets that join what such links join; ``hashes`` holds one set after the other.

    Sets of one group count as joined already.
    """
    links, n = [], len(prints)
    places = np.unique(hashes, return_inverse=True)[1]
    begin = np.cumsum(sizes) - sizes
    own = np.unique(groups, return_inverse=True)[1]
    left, marks = np.ones(n, bool), np.zeros(int(places.max(initial=-1)) + 1, np.int64)
    members = [np.flatnonzero(own == g) for g in range(int(own.max(initial=-1)) + 1)]
    for start in range(n):
        if not left[start]:
            continue
        front = list(members[own[start]])
        left[front] = False
        while front and left.any():
            at = front.pop()
            mine = places[begin[at] : begin[at] + sizes[at]]
            marks[mine] = 1
            common = np.add.reduceat(marks[places], begin)
            marks[mine] = 0
            near = left & (9 * common >= 4 * (sizes[at] + sizes))
            while near.any():
                other = int(near.argmax())
                links.append((prints[at], prints[other]))
                reached = members[own[other]]
                left[reached] = near[reached] = False
                front += list(reached)
    return links


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each task key, whose rows come one after the other; none within a block unless it is compared with itself."""
    key, rows = None, []

    def closed() -> pa.RecordBatch:
        groups, sizes = np.array([r[1] for r in rows], object), np.array([r[2] for r in rows], np.int64)
        found = spanning_links([r[0] for r in rows], groups.astype(str), sizes, np.frombuffer(b"".join(r[3] for r in rows), np.uint64))
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.string()) for i in range(2)], names=["u", "v"])

    for batch in batches:
        tasks = batch.column("task").to_pylist()
        for i, task in enumerate(tasks):
            if task != key:
                if len(rows) > 1:
                    yield closed()
                key, rows = task, []
            rows.append(tuple(batch.column(c)[i].as_py() for c in ("print", "group", "n", "hashes")))
    if len(rows) > 1:
        yield closed()


def _within(members: DataFrame, sets: DataFrame, scratch: Scratch, held: int) -> DataFrame:
    """Links between the groups that meet in the buckets ``key`` of ``key, print, n, group``."""
    blocks = members.groupBy("key").agg(F.greatest(F.lit(1), F.ceil(2 * F.sum("n") / held) - 1).cast("int").alias("blocks"))
    blocks = scratch.store(blocks, "blocks")
    cut = members.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    rows = cut.select(task.alias("task"), "print", "group", "n").join(sets, "print").select("task", "print", "group", "n", "hashes")
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(_link, LINKS).distinct()


def classes(prints: DataFrame, texts: DataFrame, scratch: Scratch, held: int = HELD) -> DataFrame:
    """``print, root, component_id`` of every set in ``doc_id, mark, print, n, keys, fingerprint``; ``texts`` has ``mark, text``."""
    spark = prints.sparkSession
    near = Scratch(spark, "similar-fingerprints")
    pairs = scratch.store(_fingerprint_pairs(prints, near), "fingerprint-pairs")
    near.drop("sets", "one", "bucket-links", "links")
    each = scratch.store(prints.groupBy("print").agg(F.min("doc_id").alias("first"), F.min("mark").alias("mark")), "prints")
    members = prints.select("print", "n", F.posexplode("keys").alias("band", "key")).distinct()
    members = scratch.store(members, "members")
    shared = scratch.store(members.groupBy("key").count().where("count > 1").select("key"), "shared")
    members = scratch.store(members.join(shared, "key", "left_semi"), "candidates")
    asked = members.select("print").unionByName(pairs.select(F.explode(F.array("u", "v")).alias("print"))).distinct()
    marks = scratch.store(each.join(asked, "print", "left_semi").select("mark").distinct(), "marks")
    sets = texts.join(marks, "mark", "left_semi").select("text").mapInArrow(_sets, "print string, hashes binary")
    sets = scratch.store(sets.groupBy("print").agg(F.any_value("hashes").alias("hashes")), "sets")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = scratch.store(pairs, f"{name}-pairs")
        a, b = (sets.select(F.col("print").alias(p), F.col("hashes").alias(h)) for p, h in (("u", "a"), ("v", "b")))
        return scratch.store(pairs.join(b, "v").join(a, "u").select("u", "v", "a", "b").mapInArrow(_verified, LINKS), name)

    links = verified(pairs.unionByName(_neighbours(members.where(F.col("band") < FIRST_BANDS))).distinct(), "first-links")
    rest = _grouped(members, links, Scratch(spark, "similar-groups"))
    one = rest.groupBy("key", "group").agg(F.min(F.struct("print", "n")).alias("one")).select("key", "one.print", "one.n")
    links = links.unionByName(verified(_neighbours(one), "group-links"))
    rest = _grouped(rest.drop("group"), links, Scratch(spark, "similar-groups"))
    links = links.unionByName(scratch.store(_within(rest, sets, scratch, held), "last-links"))
    joined = components(links, Scratch(spark, "similar-groups"))
    return simhash.rooted_classes(each, joined, scratch)


def near_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of each group, that with the smallest identifier, in the columns they came with."""
    scratch, row = Scratch(docs.sparkSession, "similar"), as_row(docs)
    mark = F.xxhash64(f"__row.{text}")
    named = row.select(
        F.col(f"__row.{key}").alias("doc_id"), mark.alias("mark"), sketches(f"__row.{text}").alias("s"), simhash.fingerprints(f"__row.{text}").alias("fingerprint")
    )
    prints = scratch.store(named.select("doc_id", "mark", "s.*", "fingerprint"), "documents")
    texts = row.select(mark.alias("mark"), F.col(f"__row.{text}").alias("text"))
    return simhash.smallest(row, prints.select("doc_id", "print"), classes(prints, texts, scratch), prints_of, scratch, text, key)
