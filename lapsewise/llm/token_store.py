"""Token ids of documents in shard files with a minimal perfect hash index.

Documents are dealt by ranges of their keys and sorted, so shards and the documents in them follow
ascending keys. A task encodes its range and writes one file: the raw ids of all documents, then the
tables of records (key, end of its ids) and the index, then the sizes of its levels and a tail that say where they are.
Ids take 2 bytes while the vocabulary fits, else 4. Only the tables stay in memory while a shard is
written, some 30 bytes a document. A manifest lists the file of each task that succeeded, some ``LISTED``
shards in a file, so what lost or repeated tasks leave behind is never read.

Index: a minimal perfect hash over the distinct keys of the shard. Level by level, keys that hash to a
place of their own set its bit and the others go on to the next level; a key's slot is the number of
bits before its own. A slot holds a fingerprint of the key, by which keys that are not in the shard
are told with an error of 1 in 2^32, and the first record of the key. Beside each word of bits stands the
number of bits before it. So a lookup reads one word of each level up to the key's own (1.7 on average),
one slot, the key, two ends and the ids, whatever the shard's size; nothing else is loaded. A whole read
takes the records of the keys in turn from the index too, loaded once for it.

Words are encoded by the tokenizers library. As no token crosses white space, texts are split at ASCII
white space, ``TEXT`` bytes or one text at a time, and each distinct word is looked up once for them; ids
of words seen before are kept (once there are more than ``WORDS``, they are gathered anew).

Defined cases: a null text counts as empty, and an empty one has the end id alone; rows with null keys
come first and have no index entry; rows with equal keys follow each other, and a lookup gives all of
them; an empty table gives an empty store; other columns are left out.
"""

from __future__ import annotations

import os
import string
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lapsewise.sources.workspace import Scratch

TOKENIZER = "word_bpe_49k.json"
END = 1
WORDS = 400_000
TEXT = 1 << 23
READ = 1 << 22
LISTED = 64  # shards in a file of the manifest
MAGIC = b"LWTS0002"
TAIL = struct.Struct("<QQQQQQQ8s")  # ids, records, of them with null keys, distinct keys, tables at, bytes an id, levels, magic
SLOT = np.dtype([("print", "<u4"), ("record", "<i8")])
PLACE = np.dtype([("bits", "<u8"), ("before", "<u8")])  # a word of a level, and the bits set before it in all levels
MANIFEST = "shard int, file string, records bigint, ids bigint, low bigint, high bigint"


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit keys."""
    h = keys.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


class PerfectHash:
    """Maps each of n distinct 64-bit keys to a number of its own below n; any other key to something."""

    FINGERPRINT = 1 << 20

    def __init__(self, levels: Sequence[np.ndarray]) -> None:
        self.levels = list(levels)  # bits in 64-bit words
        counts = [np.bitwise_count(w).astype(np.int64) for w in self.levels]
        self.ranks = [np.concatenate([[0], np.cumsum(c)[:-1]]) for c in counts]
        self.bases = np.cumsum([0, *(int(c.sum()) for c in counts)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], np.unique(keys)
        while len(left):
            words = len(left) // 32 + 1  # two places a key
            place = (_mix(left, len(levels)) % np.uint64(64 * words)).astype(np.int64)
            alone = np.bincount(place, minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[place]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys; -1 for some keys that are not in the set."""
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, words in enumerate(self.levels):
            place = _mix(keys[left], level) % np.uint64(64 * len(words))
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[left[hit]] = (self.bases[level] + self.ranks[level][word] + np.bitwise_count(below))[hit]
            left = left[~hit]
        return found

    def places(self) -> Iterator[np.ndarray]:
        """The levels as they are stored: each word beside the number of bits before it."""
        for words, ranks, base in zip(self.levels, self.ranks, self.bases, strict=False):
            place = np.empty(len(words), PLACE)
            place["bits"], place["before"] = words, ranks + base
            yield place

    @classmethod
    def fingerprint(cls, keys: np.ndarray) -> np.ndarray:
        return (_mix(keys, cls.FINGERPRINT) >> np.uint64(32)).astype("<u4")


class ShardWriter:
    """Writes one shard: documents in the order of their keys, then :meth:`close`."""

    def __init__(self, uri: str, width: int) -> None:
        system, path = fs.FileSystem.from_uri(uri)
        self.out, self.width, self.keys, self.sizes = system.open_output_stream(path), width, [], []

    def add(self, key: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.keys.append(key)
        self.sizes.append(len(ids) // self.width)

    def close(self) -> tuple[int, int, int | None, int | None]:
        """Write tables, index and tail; gives records, ids, smallest and largest key."""
        nulls = self.keys.count(None)
        keys = np.array([k for k in self.keys if k is not None], "<i8")
        ends = np.cumsum(np.array(self.sizes, "<i8"))
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        distinct = keys[first].view(np.uint64)
        index = PerfectHash.build(distinct)
        slots = index.slots(distinct)
        table = np.empty(len(distinct), SLOT)
        table["print"][slots], table["record"][slots] = PerfectHash.fingerprint(distinct), first + nulls
        total, at = int(ends[-1]) if len(ends) else 0, self.out.tell()
        for part in (keys, ends.astype("<i8"), table, *index.places(), np.array([len(w) for w in index.levels], "<u8")):
            self.out.write(part.tobytes())
        self.out.write(TAIL.pack(total, len(ends), nulls, len(distinct), at, self.width, len(index.levels), MAGIC))
        self.out.close()
        return len(ends), total, *((int(keys[0]), int(keys[-1])) if len(keys) else (None, None))


class ShardReader:
    """Reads one shard: by key, a few places of the file for each; or whole, in the order of its keys."""

    def __init__(self, uri: str) -> None:
        system, path = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        end = self.file.size() - TAIL.size
        self.ids, self.records, self.nulls, self.distinct, at, self.width, levels, magic = TAIL.unpack(self._read(end, TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no shard of token ids")
        self.words = np.frombuffer(self._read(end - 8 * levels, 8 * levels), "<u8").astype(np.int64)
        sizes = [8 * (self.records - self.nulls), 8 * self.records, SLOT.itemsize * self.distinct, *(PLACE.itemsize * self.words).tolist()]
        self.at_keys, self.at_ends, self.at_slots, *self.at_levels = [at, *(at + np.cumsum(sizes)).tolist()][: len(sizes)]

    def _read(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        return self.file.read(length)

    def _table(self, at: int, kind: str | np.dtype, first: int, n: int) -> np.ndarray:
        kind = np.dtype(kind)
        return np.frombuffer(self._read(at + first * kind.itemsize, n * kind.itemsize), kind)

    @cached_property
    def keys(self) -> np.ndarray:
        return self._table(self.at_keys, "<i8", 0, self.records - self.nulls)

    @cached_property
    def ends(self) -> np.ndarray:
        return self._table(self.at_ends, "<i8", 0, self.records)

    @cached_property
    def slots(self) -> np.ndarray:
        return self._table(self.at_slots, SLOT, 0, self.distinct)

    @cached_property
    def index(self) -> PerfectHash:
        places = [self._table(at, PLACE, 0, int(n)) for at, n in zip(self.at_levels, self.words, strict=True)]
        return PerfectHash([p["bits"].copy() for p in places])

    def key(self, record: int) -> int | None:
        return None if record < self.nulls else int(self.keys[record - self.nulls])

    def start(self, record: int) -> int:
        return int(self.ends[record - 1]) if record else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First record of each of many keys, by the whole index; -1 for keys that are not here."""
        keys = keys.astype("<i8").view(np.uint64)
        slots = self.index.slots(keys)
        here = slots >= 0
        here[here] = self.slots["print"][slots[here]] == PerfectHash.fingerprint(keys[here])
        return np.where(here, self.slots["record"][slots] if self.distinct else -1, -1)

    def find_one(self, key: int) -> int:
        """First record of a key, -1 if it is not here: reads one place of each level up to the key's own, and one slot."""
        keys = np.array([key], "<i8").view(np.uint64)
        for level, words in enumerate(self.words):
            word, bit = divmod(int(_mix(keys, level)[0]) % (64 * int(words)), 64)
            bits, before = self._table(self.at_levels[level], PLACE, word, 1)[0].tolist()
            if bits >> bit & 1:
                slot = before + (bits & ((1 << bit) - 1)).bit_count()
                mark, record = self._table(self.at_slots, SLOT, slot, 1)[0].tolist()
                return record if mark == int(PerfectHash.fingerprint(keys)[0]) else -1
        return -1

    def get(self, key: int) -> list[np.ndarray]:
        """Ids of all records of a key."""
        record, found = self.find_one(key), []
        while 0 <= record < self.records and self._table(self.at_keys, "<i8", record - self.nulls, 1)[0] == key:
            low, high = self._table(self.at_ends, "<i8", record - 1, 2) if record else (0, self._table(self.at_ends, "<i8", 0, 1)[0])
            found.append(np.frombuffer(self._read(int(low) * self.width, int(high - low) * self.width), f"<u{self.width}"))
            record += 1
        return found

    def in_key_order(self) -> np.ndarray:
        """Numbers of all records: those without key, then those the index gives for each key in turn."""
        new = np.flatnonzero(np.concatenate([[True], self.keys[1:] != self.keys[:-1]])) if len(self.keys) else np.empty(0, np.int64)
        counts = np.diff(np.append(new, len(self.keys)))
        records = np.repeat(self.find(self.keys[new]) - new, counts) + np.arange(len(self.keys))
        if (records < self.nulls).any() or not np.array_equal(self.keys[records - self.nulls], self.keys):
            raise ValueError("the index does not lead to the records of its keys")
        return np.concatenate([np.arange(self.nulls), records])

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """All records with their ids, as the index gives them; neighbours in the file are read in large pieces."""
        order, at = self.in_key_order(), 0
        while at < len(order):
            low, after = self.start(int(order[at])), at + 1
            while after < len(order) and order[after] == order[after - 1] + 1 and (int(self.ends[order[after]]) - low) * self.width <= READ:
                after += 1
            ids = np.frombuffer(self._read(low * self.width, (int(self.ends[order[after - 1]]) - low) * self.width), f"<u{self.width}")
            for record in order[at:after].tolist():
                yield record, ids[self.start(record) - low : int(self.ends[record]) - low]
            at = after

    def close(self) -> None:
        self.file.close()


class WordEncoder:
    """Ids of texts through the tokenizers library, as raw bytes of ``width`` bytes an id.

    Texts are split and their distinct words looked up by Arrow; Python sees each distinct word of a
    call once. A word of letters with marks behind it is two: its letters in lower case, and the marks.
    Such letters go to the same model without normalizer and pattern, many in a text whose ids are cut
    at the tokens that end a word. Only letters are taken for that with which a word gives the same ids
    either way, and none unless ``PROBE`` words of the vocabulary do too and marks get their ids apart.
    Other words go through the whole tokenizer: letters together as well, the rest one by one.
    """

    MARKS = string.punctuation  # after letters always one piece of their own
    LETTERS = "".join(c for c in map(chr, range(0x700)) if c.isalpha())  # Latin to Arabic, none joins the letter before it
    PROBE = 2000
    TOGETHER = 128

    def __init__(self, model: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(model)
        vocabulary = self.tokenizer.get_vocab()
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.last[i] = bool(suffix) and token.endswith(suffix)
        self.ascii, self.plain = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        self.ascii.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), to_bytes])
        self.words: dict[str, bytes] = {}
        self.letters = "".join(c for c, same in zip(self.LETTERS, self._same([f"a{c}a" for c in self.LETTERS]), strict=True) if same)
        stems = sorted(t.removesuffix(suffix or "") for t in vocabulary)
        stems = [t for t in stems if t.isascii() and t.isalpha()]
        probe = [w for t in stems[:: len(stems) // self.PROBE + 1] for w in (t.lower(), t.upper(), t)]
        if not all(self._same(probe)) or not self._apart():
            self.letters = ""

    def _raw(self, ids: Sequence[int]) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def _one_by_one(self, words: Sequence[str], tokenizer=None) -> list[bytes]:
        return [self._raw(e.ids) for e in (tokenizer or self.tokenizer).encode_batch_fast(words, add_special_tokens=False)]

    def _same(self, words: Sequence[str]) -> list[bool]:
        """Whether each word gets its ids without normalizer and pattern too, and ends where it should."""
        lower = pc.utf8_lower(pa.array(words, pa.string())).to_pylist()
        whole, plain, short = (self._one_by_one(*x) for x in ((words,), (lower, self.plain), (lower, self.ascii)))
        ends = [np.flatnonzero(self.last[np.frombuffer(ids, f"<u{self.width}")]).tolist() == [len(ids) // self.width - 1] for ids in plain]
        return [w == p and e and (w == s or not t.isascii()) for w, p, s, e, t in zip(whole, plain, short, ends, words, strict=True)]

    def _apart(self) -> bool:
        """Whether one mark or two behind a letter get the ids that they get alone."""
        marks = [a + b for a in self.MARKS for b in ("", *self.MARKS)]
        letter = self._one_by_one(["a"])[0]
        return self._one_by_one([f"a{m}" for m in marks]) == [letter + ids for ids in self._one_by_one(marks)]

    def _together(self, words: Sequence[str], tokenizer) -> Iterator[bytes]:
        parts = [words[i : i + self.TOGETHER] for i in range(0, len(words), self.TOGETHER)]
        for part, encoding in zip(parts, tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False), strict=True):
            ids = np.array(encoding.ids, f"<u{self.width}")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                yield from self._one_by_one(part)
                continue
            raw, at = ids.tobytes(), [0, *(ends * self.width).tolist()]
            yield from (raw[a:b] for a, b in zip(at, at[1:], strict=False))

    def _known(self, words: pa.Array, plain: bool = False) -> pa.Array:
        """Ids of distinct words, as they stand; ``plain`` if all are of plain letters in lower case."""
        keys, known, single = words.to_pylist(), self.words, []
        new = [w for w in keys if w not in known]
        if plain:
            groups = [([w for w in new if w.isascii()], self.ascii), ([w for w in new if not w.isascii()], self.plain)]
        else:
            letters = [w.isalpha() and w[-1].lower().isalpha() for w in new]
            groups = [([w for w, x in zip(new, letters, strict=True) if x], self.tokenizer)]
            single = [w for w, x in zip(new, letters, strict=True) if not x]
        for together, tokenizer in groups:
            known.update(zip(together, self._together(together, tokenizer), strict=True))
        known.update(zip(single, self._one_by_one(single), strict=True))
        return pa.array([known[w] for w in keys], pa.large_binary())

    def _ids(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words."""
        if not self.letters:
            return self._known(words)
        stems = pc.ascii_rtrim(words, self.MARKS)
        plain = pc.match_substring_regex(stems, rf"\A[{self.letters}]+\z")
        tails = pc.utf8_ltrim(words.filter(plain), self.letters).dictionary_encode()
        stems = pc.utf8_lower(stems.filter(plain)).dictionary_encode()
        both = [self._known(x.dictionary, p).take(x.indices) for x, p in ((stems, True), (tails, False))]
        rest = self._known(words.filter(pc.invert(plain)))
        mask = plain.to_numpy(zero_copy_only=False)
        place = np.where(mask, np.cumsum(mask) - 1, mask.sum() + np.cumsum(~mask) - 1)
        return pa.concat_arrays([pc.binary_join_element_wise(*both, pa.scalar(b"", pa.large_binary())), rest]).take(pa.array(place))

    def encode(self, texts: pa.Array | Sequence[str | None]) -> Iterator[bytes]:
        if len(self.words) > WORDS:
            self.words.clear()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))  # with empty words at blank ends, which have no ids
        words = split.flatten().dictionary_encode()
        ids = self._ids(words.dictionary).take(words.indices)
        ends = np.frombuffer(ids.buffers()[1], "<i8", len(ids) + 1, 8 * ids.offset) if len(ids) else np.zeros(1, np.int64)
        raw, at = memoryview(ids.buffers()[2] or b""), ends[np.cumsum([0, *pc.list_value_length(split).to_pylist()])].tolist()
        end = END.to_bytes(self.width, "little")
        for a, b in zip(at, at[1:], strict=False):
            yield bytes(raw[a:b]) + end


@lru_cache(maxsize=4)
def _encoder(model: str) -> WordEncoder:
    return WordEncoder(model)


def _batches(column: pa.Array, most: int = TEXT) -> Iterator[tuple[int, pa.Array]]:
    """Texts a few at a time, by their length: ``most`` bytes and one text at the most."""
    ends, start = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy()), 0
    while start < len(column):
        after = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most)) + 1
        yield start, column.slice(start, after - start)
        start = after


def write_store(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """Write the documents' ids under ``path``; gives the manifest, which is written too."""
    spark = docs.sparkSession
    with open(model or public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        tokenizer = spark.sparkContext.broadcast(file.read())  # a vocabulary, whatever the input

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer, encoder = TaskContext.get().partitionId(), None, _encoder(tokenizer.value)
        uri = f"{path}/shard-{shard:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for start, texts in _batches(batch.column(1)):
                writer = writer or ShardWriter(uri, encoder.width)
                for k, ids in zip(keys[start:], encoder.encode(texts), strict=False):
                    writer.add(k, ids)
        if writer:
            yield pa.RecordBatch.from_pylist([dict(zip(("records", "ids", "low", "high"), writer.close(), strict=True)) | {"shard": shard, "file": uri}], schema=schema)

    schema = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("ids", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]  # so that even rows of one key can be dealt out
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # made first, wherever it is
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    written = dealt.mapInArrow(write, MANIFEST).repartition(parts, "shard")  # by number, so that a task run again is listed in the same place
    written.coalesce(parts // LISTED + 1).write.parquet(f"{path}/manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """The manifest with ``base``, the ids in all shards before: a row for each file."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = read_manifest(spark, path).withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    return shards.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard")


def read_store(spark: SparkSession, path: str, columns: str, take: Callable[[np.ndarray], dict]) -> DataFrame:
    """``doc_id, start, n_tokens`` of all records in order of the shards, and the ``columns`` that ``take`` gives for the ids."""
    kinds = StructType.fromDDL(f"doc_id bigint, start bigint, n_tokens bigint, {columns}")
    schema = to_arrow_schema(kinds)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, found = ShardReader(row["file"]), []
                for record, ids in shard.documents():
                    found.append({"doc_id": shard.key(record), "start": row["base"] + shard.start(record), "n_tokens": len(ids)} | take(ids))
                    if len(found) == 1024:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found = []
                shard.close()
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema)

    return _shards(spark, path).select("file", "base").mapInArrow(read, kinds)


def fetch(keys: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``key, ids`` of the records of the given keys, read through the index; keys that are not stored give no row.

    The bounds of the shards, 16 bytes for each file, tell every task where a key can be.
    """
    spark = keys.sparkSession
    bounds = read_manifest(spark, path).where("low IS NOT NULL").orderBy("shard").select("file", "low", "high").toArrow()
    files, low, high = bounds["file"].to_pylist(), bounds["low"].to_numpy(), bounds["high"].to_numpy()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0).to_numpy()
            first, last = np.searchsorted(high, wanted, "left"), np.searchsorted(low, wanted, "right")
            pairs = [(files[s], int(k)) for k, a, b in zip(wanted, first, last, strict=True) for s in range(a, b)]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], t) for i, t in enumerate((pa.string(), pa.int64()))], names=["file", "key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, name = None, None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    shard, name = ShardReader(row["file"]), row["file"]
                found += [{"key": row["key"], "ids": ids.astype(np.int32)} for ids in shard.get(row["key"])]
            yield pa.RecordBatch.from_pylist(found, pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int32()))]))

    wanted = keys.select(F.col(key).cast("bigint").alias("key")).where("key IS NOT NULL").distinct()
    placed = wanted.mapInArrow(place, "file string, key bigint").repartition("file").sortWithinPartitions("file", "key")
    return placed.mapInArrow(read, "key bigint, ids array<int>").withColumnRenamed("key", key)


def _crc(ids: np.ndarray) -> dict:
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}


def store_report(docs: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every row, read back from the files."""
    path = Scratch(docs.sparkSession, "tokens").path("store")
    write_store(docs, path)
    return read_store(docs.sparkSession, path, "ids_crc32 bigint", _crc)
