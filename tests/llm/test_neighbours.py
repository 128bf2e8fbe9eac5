from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapsewise.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, rep int, bucket int"


def plain_nearest(rows, asked):
    """All candidates of each query, nearest first, ties to the smaller identifier."""
    good = [(i, np.array(v, np.float64)) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    size = max({len(v) for _, v in good}, key=[len(v) for _, v in good].count, default=0)
    good = list({(i, v.tobytes()): (i, v) for i, v in good if len(v) == size}.values())
    out = {}
    for i, v in good:
        if asked(i):
            out[i] = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in good if j != i)
    return out


def held(found):
    by_query = {}
    for r in found.collect():
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x) for q, x in by_query.items()}


def recall(got, expected):
    hits = total = 0
    for query, every in expected.items():
        places = got.get(query, [])
        assert [p[0] for p in places] == list(range(1, min(10, len(every)) + 1))
        assert [(p[2], p[1]) for p in places] == sorted((p[2], p[1]) for p in places)
        true = dict((j, d) for d, j in every)
        assert all(p[2] == pytest.approx(true[p[1]], abs=1e-12) for p in places)
        hits += len({j for _, j in every[:10]} & {p[1] for p in places})
        total += min(10, len(every))
    return hits / max(1, total)


def vectors(n, size, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, size)) * 2
    return (centres[rng.integers(0, 8, n)] + rng.standard_normal((n, size)) * 0.5).astype(np.float32).tolist()


def test_probes_are_valid_and_in_order_of_cost():
    order = neighbours.probe_order(5, 60)
    assert order[0] == () and len(set(order)) == len(order) == 60
    assert all(11 - j not in s for s in order for j in s)


@pytest.mark.parametrize("block", [1 << 14, 40])
def test_recall_and_exact_distances(spark, block, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "VISITS", block)
    rows = [(i, v, 0, 0) for i, v in enumerate(vectors(1200, 12, 1))]
    got = held(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0)[0])
    assert recall(got, plain_nearest(rows, lambda i: i % 20 == 0)) >= 0.9


@pytest.mark.parametrize("order", [1, 2])
def test_any_number_of_ties_at_the_border(order):
    """Two-hot vectors have only three distances from one another."""
    size, rng = 64, np.random.default_rng(order)
    base = np.zeros((size * (size - 1) // 2, size))
    for row, places in zip(base, np.argwhere(np.triu(np.ones((size, size)), 1)), strict=True):
        row[places] = 1
    reps, asked = rng.permutation(len(base)), rng.choice(len(base), 21, replace=False)
    near = np.sqrt(((base[asked][:, None] - base[reps]) ** 2).sum(axis=-1))
    expected = {(int(q), int(reps[j]), float(d[j])) for q, d in zip(asked, near, strict=True) for j in np.lexsort((reps, d))[: neighbours.NEAREST + 1]}

    def batch(which, query):
        columns = [pa.array([0] * len(which), pa.int64()), pa.array([0] * len(which), pa.int32()), pa.array([query] * len(which))]
        columns += [pa.array(which, pa.int64()), pa.array([base[i].tobytes() for i in which], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "part", "query", "rep", "vector"])

    found = neighbours._search(size)(iter([batch(asked, True), batch(reps[:700], False), batch(reps[700:], False)]))
    assert {(r["query"], r["rep"], r["distance"]) for b in found for r in b.to_pylist()} == expected


def test_common_vectors_ties_and_odd_rows(spark):
    base = vectors(60, 4, 2)
    rows = [(i, v, 0, 0) for i, v in enumerate(base)] + [(1000 + i, base[0], 0, 0) for i in range(40)] + [(1000, base[0], 0, 0)]
    rows += [(200, None, 0, 0), (300, [0.0] * 4, 0, 0), (400, [1.0, None, 1.0, 1.0], 0, 0), (500, [float("nan")] * 4, 0, 0), (600, [float("inf"), 1.0, 1.0, 1.0], 0, 0)]
    rows += [(700, [1.0, 2.0], 0, 0), (800, [], 0, 0), (None, base[1], 0, 0), (1100, base[5], 0, 0), (1100, base[6], 0, 0)]
    got = held(neighbours.neighbour_report(spark.createDataFrame(rows, SCHEMA)))
    expected = plain_nearest([r for r in rows if r[0] != 1100], lambda i: i % 100 == 0)
    assert set(got) - {1100} == set(expected) == {0, 1000}
    assert [p[1] for p in got[0]] == [1000 + i for i in range(10)] and [p[1] for p in got[1000]] == [0, *range(1001, 1010)]


@pytest.mark.parametrize("n", [0, 1, 2, 7])
def test_few_rows(spark, n):
    rows = [(100 * i, v, 0, 0) for i, v in enumerate(vectors(n, 3, 3))]
    got = held(neighbours.neighbour_report(spark.createDataFrame(rows, SCHEMA)))
    assert recall(got, plain_nearest(rows, lambda i: True) if n > 1 else {}) == (n > 1)


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert recall(held(neighbours.neighbour_report(table)), plain_nearest(rows, lambda i: i % 100 == 0)) >= 0.9


def test_outliers_are_asked_in_shares(spark, monkeypatch):
    """A fifth of the vectors lie far from all others: their exact search is dealt to many tasks."""
    rng = np.random.default_rng(12)
    near, far = rng.normal(size=(800, 8)), rng.normal(size=(200, 8)) * 10.0 ** rng.integers(2, 6, (200, 1))
    table = np.concatenate([near, far])
    rows = [(i, np.ascontiguousarray(v, "<f8").tobytes()) for i, v in enumerate(table)]
    base = spark.createDataFrame(rows, "rep bigint, vector binary")
    asked = base.where("rep >= 800")
    monkeypatch.setattr(neighbours, "VISITS", 16)
    dealt, seen = neighbours._dealt, []
    monkeypatch.setattr(neighbours, "_dealt", lambda frame, d: seen.append(frame) or dealt(frame, d))
    found = {(r.query, r.rep) for r in neighbours.search_all(base, asked, 8, 4).collect()}
    most = seen[0].where("query").groupBy("bucket", "part").count().agg({"count": "max"}).first()[0]
    assert most < 40
    for q in range(800, 1000):
        order = np.lexsort((np.arange(1000), np.sqrt(((table - table[q]) ** 2).sum(axis=1))))[: neighbours.NEAREST + 1]
        assert {(q, int(i)) for i in order} <= found
