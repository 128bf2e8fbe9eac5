from __future__ import annotations

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lapsewise.llm import token_store
from lapsewise.sources.workspace import Scratch

SCHEMA = "doc_id bigint, text string, start string, key int"


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path(token_store.TOKENIZER), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def reference(model):
    tokenizer = Tokenizer.from_str(model)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def texts(n=4000):
    random.seed(4)
    parts = ["the", "Ing", " ", "  ", "\n", "\t", "a", "É", "é", "́", "̧", "漢", "🙂", "\x1c", "\x85", "\xa0", "1", "22", "'s", "'LL", "!", "ΑΣ", "İ", "ß", "<|endoftext|>", "\x0b", "\x00", "ﬁ", "Ⅷ", "İ.", "x.y,z"]
    return ["", " ", *("".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(n))]


@pytest.mark.parametrize("most", [token_store.WORDS, 10])
def test_words_are_encoded_as_whole_texts_are(model, reference, most, monkeypatch):
    monkeypatch.setattr(token_store, "WORDS", most)
    encoder, every = token_store.WordEncoder(model), texts()
    for start in range(0, len(every), 50):
        part = every[start : start + 50]
        assert [np.frombuffer(raw, f"<u{encoder.width}").tolist() for raw in encoder.encode(part)] == [reference(t) for t in part]


class Counted:
    """A tokenizer that counts the words it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.words += sum(len(t.split()) for t in texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_a_word_is_encoded_once_whatever_its_case_and_marks(model, reference):
    random.seed(9)
    stems = sorted({"".join(random.choices("abeinorstüéñжλ", k=8)) for _ in range(400)})
    encoder = token_store.WordEncoder(model)
    counted = [Counted(t) for t in vars(encoder).values() if hasattr(t, "encode_batch_fast")]
    for name, t in list(vars(encoder).items()):
        if hasattr(t, "encode_batch_fast"):
            setattr(encoder, name, next(c for c in counted if c.tokenizer is t))
    for form in ("{}", "{}.", "{},", "{}***", "{}?!", "{}'"):
        for case in (str.lower, str.upper, str.title):
            text = " ".join(form.format(case(w)) for w in stems)
            assert [np.frombuffer(raw, f"<u{encoder.width}").tolist() for raw in encoder.encode([text])] == [reference(text)]
    assert sum(c.words for c in counted) <= len(stems) + 5  # before: 18 times the words


def test_words_of_any_letters_and_marks(model, reference):
    random.seed(10)
    encoder = token_store.WordEncoder(model)
    letters = [c for c in map(chr, range(0x3200)) if c.isalpha()] + list("漢字한글각ﬁﷺ𝐀𐐀İΣς")
    near = [*letters[:150], "\u0301", "\u0338", "\u1161", "\u11a8", "1", "'", "’"]
    every = [f"{c} a{c}a {c}. {c.upper()}{c}-, A{c}'s" for c in letters]
    every += [" ".join("".join(random.choices(near, k=random.randint(1, 4))) + random.choice(["", ".", "'", "<=>", "...", "|>"]) for _ in range(8)) for _ in range(4000)]
    assert [np.frombuffer(raw, f"<u{encoder.width}").tolist() for raw in encoder.encode(every)] == [reference(t) for t in every]


def test_a_tokenizer_of_other_habits_takes_words_whole(model):
    kept = json.loads(model)
    kept["normalizer"]["normalizers"] = kept["normalizer"]["normalizers"][:2]  # upper case stays
    cased = Tokenizer.from_str(json.dumps(kept))
    encoder = token_store.WordEncoder(json.dumps(kept))
    every = ["Word, WORD word. Ébène", None, "", "Ünder THE tree"]
    assert [np.frombuffer(raw, f"<u{encoder.width}").tolist() for raw in encoder.encode(every)] == [[*cased.encode(t or "", add_special_tokens=False).ids, 1] for t in every]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_texts_go_by_their_length(kind):
    column = pa.array(["skipped", "", None, "éé" * 9, "a", "b" * 10, None, "c"], kind).slice(1)
    parts = [(start, part.to_pylist()) for start, part in token_store._batches(column, 12)]
    assert [t for _, part in parts for t in part] == column.to_pylist()
    assert [start for start, _ in parts] == np.cumsum([0, *(len(part) for _, part in parts)])[:-1].tolist()
    assert all(sum(len((t or "").encode()) for t in part[:-1]) < 12 for _, part in parts) and len(parts) > 1


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**63, n)).view(np.uint64)
    index = token_store.PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))


@pytest.fixture(scope="module")
def rows():
    made = [(i * 7 % 1009, t, "x", 1) for i, t in enumerate(texts(150))] + [(70, "again", "x", 1)] * 2 + [(None, "no id", "x", 1), (None, None, "x", 1)]
    return made + [(5000, "Long words " * 30_000, "x", 1), (-3, None, "x", 1)]


def test_report_follows_ascending_identifiers(spark, rows, reference):
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_store.store_report(spark.createDataFrame(rows, SCHEMA)).collect())
    expected = sorted((-1 if k is None else k + 10, len(i := reference(t)), zlib.crc32(np.array(i, "<u4").tobytes())) for k, t, *_ in rows)
    assert sorted((-1 if d is None else d + 10, n, c) for _, d, n, c in got) == expected
    assert [s for s, *_ in got] == np.cumsum([0, *(n for _, _, n, _ in got)])[:-1].tolist()
    keys = [-10 if d is None else d for _, d, *_ in got]
    assert keys == sorted(keys)


def test_keyed_access(spark, rows, reference):
    path = Scratch(spark, "tokens").path("store")
    manifest = token_store.write_store(spark.createDataFrame(rows, SCHEMA), path).collect()
    assert sum(r.records for r in manifest) == len(rows)
    wanted = [k for k, *_ in rows if k is not None] + [10**9, -(10**9), 1008 * 3 + 1]
    got = token_store.fetch(spark.createDataFrame([(k, 0) for k in wanted], "doc_id bigint, ids int"), path).collect()
    expected = sorted((k, reference(t)) for k, t, *_ in rows if k is not None)
    assert sorted((r.doc_id, r.ids) for r in got) == expected
    reader = token_store.ShardReader(next(r.file for r in manifest if r.low is not None))
    far = np.arange(10**6, 10**6 + 2000)
    assert (reader.find(far) == -1).all()
    reader.close()


def shard(folder, n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(-(2**62), 2**62, n)).tolist()
    writer = token_store.ShardWriter(f"{folder}/shard-{n}", 2)
    for i, key in enumerate([None, *keys, keys[-1]]):  # the last key has two records
        writer.add(key, np.array([i % 50_000] * (i % 5 + 1), "<u2").tobytes())
    writer.close()
    return keys, token_store.ShardReader(f"{folder}/shard-{n}")


@pytest.mark.parametrize("n", [1, 100, 100_000])
def test_a_lookup_reads_a_few_places_whatever_the_size(tmp_path, n, monkeypatch):
    keys, reader = shard(tmp_path, n)
    read, taken = token_store.ShardReader._read, []
    monkeypatch.setattr(token_store.ShardReader, "_read", lambda self, at, length: taken.append(length) or read(self, at, length))
    some = range(0, len(keys) - 1, max(1, len(keys) // 500))
    for i in some:
        assert [x.tolist() for x in reader.get(keys[i])] == [[(i + 1) % 50_000] * ((i + 1) % 5 + 1)]
    if n > 1:
        assert len(taken) <= 8 * len(some) and sum(taken) <= 128 * len(some)
    assert [len(x) for x in reader.get(keys[-1])] == [len(keys) % 5 + 1, (len(keys) + 1) % 5 + 1]
    taken.clear()
    assert all(reader.get(k) == [] for k in range(2**62, 2**62 + 300))
    assert sum(taken) <= 300 * 16 * (len(reader.words) + 1) and max(taken) <= 16
    assert not {"keys", "ends", "slots", "index"} & set(vars(reader))
    reader.close()


def test_whole_read_goes_by_the_index(tmp_path):
    keys, reader = shard(tmp_path, 2000)
    assert [reader.key(r) for r, _ in reader.documents()] == [None, *keys, keys[-1]]
    assert all((reader.find_one(k) == r) for k, r in zip(keys, reader.find(np.array(keys)).tolist(), strict=True))
    reader.slots = reader.slots.copy()
    reader.slots["record"][7] += 1  # an index that is wrong is noticed
    with pytest.raises(ValueError, match="index"):
        list(reader.documents())
    reader.close()


def test_files_of_failed_tasks_are_not_read(spark, rows, reference, tmp_path):
    path = Scratch(spark, "tokens").path("store")
    token_store.write_store(spark.createDataFrame(rows[:5], SCHEMA), path)
    folder = path.removeprefix("file:")
    with open(f"{folder}/shard-000000-left-behind", "wb") as file:
        file.write(b"half")
    read = token_store.read_store(spark, path, "ids array<int>", lambda ids: {"ids": ids.tolist()})
    assert sorted((r.doc_id, r.ids) for r in read.collect()) == sorted((k, reference(t)) for k, t, *_ in rows[:5])


def test_a_file_of_the_manifest_lists_many_shards(spark, rows):
    path = Scratch(spark, "tokens").path("store")
    manifest = token_store.write_store(spark.createDataFrame(rows, SCHEMA), path)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r.shard for r in manifest.collect()) == sorted({r.shard for r in manifest.collect()})
    assert 1 < manifest.count() <= parts and len(manifest.inputFiles()) <= parts // token_store.LISTED + 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert token_store.store_report(docs).count() == 0
    path = Scratch(spark, "tokens").path("store")
    token_store.write_store(docs, path)
    assert token_store.fetch(spark.range(3).select(F.col("id").alias("doc_id")), path).count() == 0
