"""Piecewise fingerprints: the whole report against a plain reading, and what likeness means."""

from __future__ import annotations

import hashlib
import random

from lapsewise.llm import piecewise
from lapsewise.llm.piecewise import fingerprint, likeness_of, parse, print_of

SCHEMA = "doc_id bigint, text string, fingerprint string, kind int"


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def plain_ends(text, block):
    """Ends of chunks, one code point after the other."""
    ends = []
    for i in range(len(text)):
        h = sum(ord(text[i - j]) * pow(piecewise.FACTOR, j) for j in range(piecewise.WINDOW) if i - j >= 0) % 2**32
        h ^= h >> 15
        h = h * 0x85EBCA6B % 2**32
        h ^= h >> 13
        h = h * 0xC2B2AE35 % 2**32
        h ^= h >> 16
        if h % block == block - 1:
            ends.append(i + 1)
    return ends


def plain_report(rows):
    """``rows`` of ``(doc_id, text)`` in the columns of the report."""
    ordered = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for i, (key, text) in enumerate(ordered):
        following, half = ordered[(i + 1) % len(ordered)][1], len(text) // 2
        new = text[: len(text) - half] + following[:half]
        own, changed = fingerprint(text), fingerprint(new)
        near = [likeness_of(parse(own), parse(x)) for x in (changed, fingerprint(following))]
        out.append((key, len(text), hashlib.sha256(new.encode()).hexdigest(), own, changed, *near))
    return sorted(out, key=str)


def prose(rng, n, letters="abcdefghij klmnop éü日"):
    return "".join(rng.choice(letters) for _ in range(n))


def test_chunks_end_where_a_plain_rolling_hash_says():
    rng = random.Random(1)
    for n in (1, 6, 7, 64, 65, 700, 5000):
        text = prose(rng, n)
        made = print_of(text)
        for size, symbols in ((made.block, made.once), (2 * made.block, made.twice)):
            ends = plain_ends(text, size)
            assert len(symbols) == min(len(ends) + (not ends or ends[-1] < n), piecewise.LONGEST)
        assert made.block == 1 or n > piecewise.CHUNKS * made.block // 2


def test_blocks_of_long_texts_meet(monkeypatch):
    text = prose(random.Random(2), 5000)
    whole = fingerprint(text)
    monkeypatch.setattr(piecewise, "BLOCK", 64)
    assert fingerprint(text) == whole


def test_common_symbols_against_a_plain_table():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(0, 40))] for _ in range(2))
        assert piecewise._common(a, b) == plain_common(a, b)


def test_likeness():
    rng = random.Random(4)
    text = prose(rng, 4000)
    made = print_of(text)
    assert likeness_of(made, made) == 1 and parse(str(made)) == made
    moved = print_of("a new beginning " + text[:2000] + text[2040:])
    assert 0.8 < likeness_of(made, moved) < 1
    assert likeness_of(made, print_of(prose(rng, 4000))) < 0.1
    assert 0.5 < likeness_of(made, print_of(text[:2100])) < 0.8  # half the text, half the block size
    assert likeness_of(made, print_of(text[:300])) == 0
    assert fingerprint(None) == fingerprint("") == "1::" and likeness_of(print_of(""), made) == 0
    repeated = print_of(prose(rng, 11) * 100_000)
    assert len(repeated.once) <= piecewise.LONGEST
    assert likeness_of(repeated, made) == 0


def test_report(spark):
    rng = random.Random(5)
    rows = [(i * 3, prose(rng, rng.choice((0, 1, 2, 40, 300, 3000)))) for i in range(120)]
    rows += [(5, None), (5, ""), (5, "b" * 50), (5, "a" * 50), (None, "no name"), (None, None), (-4, "x" * 200_000), (9, rows[3][1]), (9, rows[3][1])]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(7)
    assert sorted(map(tuple, piecewise.fingerprint_report(docs).collect()), key=str) == plain_report(rows)


def test_few_rows(spark):
    assert piecewise.fingerprint_report(spark.createDataFrame([], SCHEMA)).count() == 0
    for rows in ([(1, "alone here")], [(1, "one of two"), (2, None)]):
        out = piecewise.fingerprint_report(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
        assert sorted(map(tuple, out.collect()), key=str) == plain_report(rows)


def test_columns(spark):
    docs = spark.createDataFrame([(1, "some text to hash"), (2, None)], "k int, t string")
    prints = docs.select("k", piecewise.fingerprints("t").alias("p"))
    rows = prints.select("k", "p", piecewise.likeness("p", "p").alias("same")).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, fingerprint("some text to hash"), 1.0), (2, "1::", 1.0)]
