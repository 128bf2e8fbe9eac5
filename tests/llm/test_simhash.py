from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from lapsewise.llm import simhash
from lapsewise.llm.components import components
from lapsewise.sources.workspace import Scratch

SCHEMA = "doc_id bigint, text string, print string, component_id int, key int"


def plain_print(text):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = lower.split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    """Of each fingerprint the set it is linked with."""
    each, seen, classes = sorted(set(prints)), set(), {}
    for start in each:
        if start in seen:
            continue
        reached, front = {start}, [start]
        while front:
            at = front.pop()
            near = [p for p in each if p not in reached and (p ^ at).bit_count() <= 4]
            reached.update(near)
            front += near
        seen |= reached
        classes |= dict.fromkeys(reached, frozenset(reached))
    return classes


def signed(prints):
    return np.array(prints, np.uint64).view(np.int64).tolist()


def near(print_, bits, rng):
    return print_ ^ sum(1 << b for b in rng.sample(range(64), bits))


def test_fingerprints(monkeypatch):
    random.seed(1)
    texts = ["", None, " \n", "One", "a b C", "a b c d", "É É É É é", "x " * 999] + [" ".join(random.choices("abcdefgh", k=k)) for k in range(60)]
    expected = [plain_print(t) for t in texts]
    assert [simhash.fingerprint(t) for t in texts] == expected and expected[:3] == [0, 0, 0]
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert [simhash.fingerprint(t) for t in texts] == expected


def test_golay_code_is_perfect():
    rng = random.Random(2)
    words = np.array([rng.randrange(1 << 23) for _ in range(2000)])
    codes = simhash.index(words)
    checks, _ = simhash._golay()
    assert max(int(x).bit_count() for x in words ^ (codes << 11 | checks[codes])) == 3
    assert set((simhash.nearby(words, 23) >= 0).sum(axis=1).tolist()) == {1, 6}


@pytest.mark.parametrize("bits", range(5))
def test_linked_fingerprints_share_a_key(bits):
    rng = random.Random(bits)
    left = [rng.getrandbits(64) for _ in range(500)]
    right = [near(p, bits, rng) for p in left]
    found = []
    for prints in (left, right):
        keys, rows = simhash.keys(np.array(prints, np.uint64))
        each = [set() for _ in prints]
        for key, row in zip(keys.tolist(), rows.tolist(), strict=True):
            each[row].add(key)
        found.append(each)
    assert all(a & b for a, b in zip(*found, strict=True))


@pytest.fixture(scope="module")
def prints():
    """Chains, dense groups, lone fingerprints, repeats."""
    rng, made = random.Random(5), [0, 1, 0, (1 << 64) - 1]
    for _ in range(40):
        made.append(rng.getrandbits(64))
        for _ in range(rng.randrange(6)):
            made.append(near(made[-1], rng.randrange(1, 7), rng))
    base = rng.getrandbits(64)
    return made + [near(base, rng.randrange(5), rng) for _ in range(300)]


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 8])
def test_classes_agree_with_all_pairs(spark, prints, bucket):
    rows = [(i, p) for i, p in enumerate(signed(prints))]
    got = simhash.classes(spark.createDataFrame(rows, "doc_id bigint, print bigint"), Scratch(spark, "t"), bucket).collect()
    classes = plain_classes(prints)
    first = {}
    for i, p in enumerate(prints):
        first[classes[p]] = min(i, first.get(classes[p], i))
    assert {r.print % (1 << 64): r.component_id for r in got} == {p: first[classes[p]] for p in prints}


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 300)] + [(1000, 1001 + i) for i in range(200)] + [(5, 5), (2000, 3), (2000, 4)]
    random.Random(1).shuffle(links)
    got = components(spark.createDataFrame(links, "u bigint, v bigint"), Scratch(spark, "c")).collect()
    expected = {n: 100 for n in range(100, 301)} | {1000 + i: 1000 for i in range(201)} | {2000: 3, 3: 3, 4: 3}
    assert {r.node: r.component for r in got} == expected


def rows():
    rng = random.Random(8)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(3000))
    made = [(30, long, "x", 1, 1), (20, long + " z", "x", 1, 1), (25, long.upper(), "x", 1, 1), (None, long, "x", 1, 1), (40, None, "x", 1, 1), (41, " ", "x", 1, 1)]
    made += [(50 + i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(40)), "x", 1, 1) for i in range(30)]
    return made + [(50, made[6][1], "x", 1, 1), (20, "one of its own", "x", 1, 1)]


def test_report_and_kept_rows(spark):
    docs, prints = spark.createDataFrame(rows(), SCHEMA), [plain_print(t) for _, t, *_ in rows()]
    classes, first = plain_classes(prints), {}
    for (key, *_), p in zip(rows(), prints, strict=True):
        if key is not None:
            first[classes[p]] = min(key, first.get(classes[p], key))
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_dup_report(docs).collect()), key=str)
    assert got == sorted(((k, f"{p:016x}", first[classes[p]]) for (k, *_), p in zip(rows(), prints, strict=True)), key=str)
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(plain_print(r.text) in classes and first[classes[plain_print(r.text)]] == r.doc_id for r in kept.collect()) == [True] * len(set(classes.values()))


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_dup_report(docs).count() == 0 and simhash.near_dedup(docs).count() == 0
