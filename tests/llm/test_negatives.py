"""Hard negatives against all scores."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewise.llm import negatives

SCHEMA = "vec_id bigint, label int, embedding array<float>, id string, score int"


def plain(rows, positives=5, count=5):
    """Rows ``(id, label, vector)`` of whole numbers, one for each id; anchors are divisible by 100."""
    found = []
    size = max((len(v) for *_, v in rows), default=0)
    vectors = {i: [*v, *[0] * (size - len(v))] for i, _, v in rows}
    labels = {i: label for i, label, _ in rows}
    for a in sorted(i for i in vectors if i % 100 == 0):
        score = {i: sum(x * y for x, y in zip(vectors[a], v, strict=True)) for i, v in vectors.items()}
        near = sorted((-score[i], i) for i in vectors if i != a and labels[i] == labels[a])[:positives]
        for minus, p in near:
            inside = sorted((-score[i], i) for i in vectors if labels[i] != labels[a] and 80 * -minus <= 100 * score[i] <= 100 * -minus)
            found += [(a, p, r, i, -minus, -s) for r, (s, i) in enumerate(inside[:count], 1)]
    return sorted(found)


def taking_part(rows):
    """What takes part of ``(id, label, vector)`` rows, with the query's labels."""
    good = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        row = (str(label), list(v))
        good[i] = min(good.get(i, row), row)
    return [(i, label, [math.floor(256 * x) for x in v]) for i, (label, v) in good.items()]


def got(spark, rows, schema=SCHEMA):
    table = spark.createDataFrame([(*r, "x", 1)[: len(schema.split(","))] for r in rows], schema)
    return sorted(tuple(r) for r in negatives.negative_report(table).collect())


def test_random_ties_hot_vector_and_odd_rows(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        v = [rng.choice((-0.5, 0.25, 0.5, 1.0)) for _ in range(6)]
        rows.append((i, rng.randrange(10), [0.5] * 6 if i % 3 == 0 else v))
    rows += [(2000, 1, None), (2100, None, [1.0] * 6), (2200, 2, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2300, 3, [float("nan")] * 6), (None, 3, [1.0] * 6)]
    rows += [(2400, 3, [float("inf")] * 6), (2500, 4, []), (2600, 4, [1.0, 1.0]), (100, 0, [9.0] * 6), (100, 0, [9.0] * 6), (7, 3, [0.125] * 6)]
    assert got(spark, rows) == plain(taking_part(rows))


def test_many_blocks_and_stripes(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, int(x), v.tolist()) for i, (x, v) in enumerate(zip(rng.integers(0, 10, 3000), rng.normal(size=(3000, 12)).astype(np.float32)))]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    members = negatives._members(table, "vec_id", F.col("label"), "embedding")
    monkeypatch.setattr(negatives, "BLOCK", 12 * 8 * 64)
    blocks = negatives.packed(members, 12).collect()
    assert len(blocks) > 30 and sum(len(b.ids) for b in blocks) == 8 * 3000
    assert got(spark, rows) == plain(taking_part(rows))


def test_scores_beyond_doubles_and_bigints(spark):
    rows = [(100, 1, [2.0**40, 1.0]), (1, 1, [2.0**40, 3.0]), (2, 2, [2.0**40, 2.0]), (3, 2, [2.0**40, -5.0]), (4, 2, [2.0, 0.0]), (5, 3, [0.0, 7.0])]
    limit = 2**63 - 1
    out = got(spark, rows, "vec_id bigint, label int, embedding array<double>")
    assert [r[:4] for r in out] == [(100, 1, 1, 2), (100, 1, 2, 3)] and {r[4] for r in out} == {limit}
    rows = [(i, label, [x * 2.0**-19 if j == 0 else x for j, x in enumerate(v)]) for i, label, v in rows]
    assert got(spark, rows, "vec_id bigint, label int, embedding array<double>") == plain(taking_part(rows))


def test_empty_and_few(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, 1, [1.0])]) == []
    assert got(spark, [(0, 1, [1.0]), (1, 1, [1.0]), (2, 1, [1.0])]) == []
    assert got(spark, [(100, 2, [1.0]), (1, 2, [1.0]), (2, 3, [1.0])]) == [(100, 1, 1, 2, 65536, 65536)]


@pytest.mark.parametrize("shape", [(1, 3), (17, 1), (500, 40), (333, 2)])
def test_tiles_hold_every_row_once(shape):
    vectors = np.random.default_rng(1).normal(size=shape)
    assert sorted(negatives.tiled(vectors)) == list(range(shape[0]))


def test_boxes_prune():
    """A clear neighbourhood is found without scoring most rows."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 8)) * 4000
    vectors = np.floor(np.concatenate([c + rng.normal(size=(100, 8)) * 5 for c in centres]))
    order = negatives.tiled(vectors)
    trees = negatives.Trees([("a", order, vectors[order])])
    scored = []
    plain_scores = trees.scores
    trees.scores = lambda anchor, a, b: scored.append(b - a) or plain_scores(anchor, a, b)
    anchor = vectors[0]
    low, high = (e[0].tolist() for e in trees.intervals(anchor[None]))
    best = trees.best(anchor, -1, [trees.roots[0][1]], low, high, [negatives.LONGS], 5)[0]
    expected = sorted((-int(s), i) for i, s in enumerate(vectors @ anchor))[:5]
    assert best == expected and sum(scored) < len(vectors) / 4
