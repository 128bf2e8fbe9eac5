from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from lapsewise.llm import bpe

SCHEMA = "doc_id bigint, text string, ids string, n_tokens string"


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path(bpe.RANKS), "rb") as file:
        return bpe.parse_ranks(file.read())


@pytest.fixture(scope="module")
def reference(ranks):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: encoding.encode_ordinary(text or "")


@pytest.fixture(scope="module")
def tokenizer(ranks):
    return bpe.Tokenizer(ranks)


def ids(raw):
    return [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]


def texts():
    random.seed(3)
    parts = ["the", "ing", " ", "  ", "\n", "\t", "a", "é", "漢", "🙂", "\x1c", "\x85", "\xa0", "12", "'s", "'ll", "!", "aaaa", "<|endoftext|>", "\x00"]
    mixed = ["".join(random.choices(parts, k=random.randint(0, 15))) for _ in range(3000)]
    letters = ["".join(random.choices("etaoinshrdlu", k=random.randint(1, 80))) for _ in range(500)]
    wild = ["".join(chr(random.choice((random.randrange(128), random.randrange(0x3000), random.randrange(0x10000, 0x1FFFF)))) for _ in range(20)) for _ in range(500)]
    return ["", " ", *mixed, *letters, *wild]


def test_transducer_agrees_with_the_reference_library(tokenizer, reference):
    for text in texts():
        assert ids(tokenizer.encode(text)) == reference(text), text


def test_states_started_anew_give_the_same_ids(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "STATES", 50)
    monkeypatch.setattr(bpe, "PIECES", 20)
    small = bpe.Tokenizer(ranks)
    assert all(ids(small.encode(t)) == reference(t) for t in texts()[:800])
    assert len(small.pieces.transducer.states) < 200


def test_long_texts_are_split_where_nothing_crosses(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 13)
    small, long = bpe.Tokenizer(ranks), "One two  three\n four 's five" * 20 + "x" * 500 + " \n " * 50
    assert ids(small.encode(long)) == reference(long)
    assert all(ids(small.encode(t)) == reference(t) for t in texts()[:800])


def test_decoding_is_a_stream(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "IDS", 1)
    assert all(tokenizer.decode(tokenizer.encode(t)) == t for t in texts())


def test_utf8_reader_waits_for_whole_characters():
    reader, data = bpe.Utf8Reader(), "aé漢🙂".encode()
    assert "".join(reader.feed(data[i : i + 1]) for i in range(len(data))) + reader.feed(b"", final=True) == "aé漢🙂"
    assert bpe.Utf8Reader().feed(b"\xe6\xbc", final=True) == "�"


def test_report_and_rows(spark, reference):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts()[:300])] + [(7, "again", "x", "y")] * 2 + [(None, None, "x", "y"), (8, "word " * 30_000, "x", "y")]
    docs, expected = spark.createDataFrame(rows, SCHEMA), []
    for key, text, *_ in rows:
        raw = b"".join(i.to_bytes(4, "little") for i in reference(text))
        expected.append((key, len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.encode_report(docs).collect()), key=str) == sorted(expected, key=str)
    encoded = bpe.encode(docs, ("doc_id", "ids")).collect()
    assert sorted(((r.doc_id, r.token_ids) for r in encoded), key=str) == sorted(((k, reference(t)) for k, t, *_ in rows), key=str)
    assert bpe.encode_report(docs.limit(0)).count() == 0


def test_pipeline_stage_decodes_what_it_encodes(spark):
    texts = [None, "", "plain words", "Ünï 漢字 🙂 e\u0301", "x" * 5000, " \n\t  "]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.encoded(spark, docs, "").collect()}
    assert got == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts)}
