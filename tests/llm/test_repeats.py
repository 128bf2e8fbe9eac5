from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from lapsewise.llm import repeats, suffixes

SCHEMA = "doc_id bigint, text string, uid string, key int, n_bytes int"


def plain_report(rows):
    """Every 50-byte string looked up one by one."""
    first, out = {}, []
    data = [(repeats.LAST if k is None else k, k, (t or "").encode()) for k, t, *_ in rows]
    for order, _, text in data:
        for i in range(len(text) - 49):
            first[text[i : i + 50]] = min(order, first.get(text[i : i + 50], order))
    for order, key, text in data:
        gone = bytearray(len(text))
        for i in range(len(text) - 49):
            if first[text[i : i + 50]] < order:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(text)) if gone[i] and not (i and gone[i - 1]))
        out.append((key, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abc", b"\x00\x01", b"ba\xff", bytes(range(256))])
def test_two_stage_sorting(letters):
    rng = random.Random(letters[0])
    for _ in range(60):
        text = np.array(rng.choices(letters, k=rng.randint(1, 250)), np.uint8)
        word = suffixes.words(text)
        order = suffixes.suffix_order(text, word)
        parts = [bytes(text[i : i + 56]).ljust(56, b"\0") for i in range(len(text))]
        assert sorted(order.tolist()) == list(range(len(text)))
        assert [parts[i] for i in order] == sorted(parts)
        shared = suffixes.common_prefixes(order, word)
        for r in range(1, len(order)):
            a, b = parts[order[r]], parts[order[r - 1]]
            assert shared[r] == next((i for i in range(56) if a[i] != b[i]), 56)


def test_chunks_cover_every_window_once():
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"ab" if i % 2 else range(256), k=rng.randint(0, 300))) for i in range(40)] + [b"again " * 60]
    owner, start, windows, key = repeats.chunks(texts)
    got = [(t, w) for t, a, n in zip(owner, start, windows, strict=True) for w in range(a, a + n)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in range(len(t) - 49)]
    by_window = {}
    for t, a, n, k in zip(owner, start, windows, key, strict=True):
        for w in range(a, a + n):
            assert by_window.setdefault(texts[t][w : w + 50], k) == k


def rows():
    rng = random.Random(9)

    def words(n):
        return " ".join("".join(rng.choices("etaoinshrdlü", k=rng.randint(2, 9))) for _ in range(n))

    passage, long, line = words(40), words(6000), "the same line of fifty bytes and a few more, in many texts\n"
    made = [(100 + i, words(30) + passage[rng.randint(0, 60) :] + words(20), "x", 1, 1) for i in range(40)]
    made += [(200 + i, "".join(rng.choice((line, words(8) + "\n")) for _ in range(8)), "x", 1, 1) for i in range(40)]
    made += [(10, long, "x", 1, 1), (11, long, "x", 1, 1), (12, long[:20_000] + "!" + long[20_000:], "x", 1, 1), (9, long[500:900], "x", 1, 1), (11, words(50), "x", 1, 1)]
    made += [(20, "a" * 49, "x", 1, 1), (21, "a" * 49, "x", 1, 1), (22, "a" * 50, "x", 1, 1), (23, "a" * 500, "x", 1, 1), (24, "Gelich " * 300, "x", 1, 1), (25, " Gelich" * 200, "x", 1, 1)]
    made += [(30, None, "x", 1, 1), (31, "", "x", 1, 1), (None, passage, "x", 1, 1), (None, long[:3000], "x", 1, 1), (40, made[3][1], "x", 1, 1), (103, made[3][1], "x", 1, 1)]
    return made


@pytest.mark.parametrize("crowded", [repeats.CHUNKS, 1])
def test_report_agrees_with_all_strings(spark, crowded, monkeypatch):
    monkeypatch.setattr(repeats.remove_repeats, "__defaults__", ("text", "doc_id", crowded))
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    assert sorted(map(tuple, repeats.repeat_report(docs).collect()), key=str) == plain_report(rows())


def test_run_time_changes_of_partitions_lose_nothing(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        docs = spark.createDataFrame(rows(), SCHEMA).repartition(7)
        assert sorted(map(tuple, repeats.repeat_report(docs).collect()), key=str) == plain_report(rows())
        assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_small_buffers_give_the_same(spark, monkeypatch):
    few = rows()[:50]
    for name, value in (("BUFFER", 300), ("KEYS", 50), ("SORTED", 500), ("SEEN", 3)):
        monkeypatch.setattr(repeats, name, value)
    assert sorted(map(tuple, repeats.repeat_report(spark.createDataFrame(few, SCHEMA)).collect()), key=str) == plain_report(few)


def test_spans_and_kept_bytes(spark):
    text = {r[0]: (r[1] or "").encode() for r in rows() if r[0] not in (None, 11, 103)}
    for r in repeats.remove_repeats(spark.createDataFrame(rows(), SCHEMA)).collect():
        if r.doc_id in text:
            data, at, kept = text[r.doc_id], 0, b""
            for a, b in r.spans:
                kept, at = kept + data[at:a], b
            assert kept + data[at:] == (data if r.kept is None else bytes(r.kept))


def test_empty_table(spark):
    assert repeats.repeat_report(spark.createDataFrame([], SCHEMA)).count() == 0
