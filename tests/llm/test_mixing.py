from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from lapsewise.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size string, rate int"


def words(text):
    return len((text or "").replace("\x0b", " ").replace("\x0c", " ").split()) if text else 0


def shares(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by repeated sharing out, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), {}
    while True:
        rest = sum(weight[s] for s in order if s not in full)
        if not rest:
            return full
        level = (total - sum(full.values())) / rest
        above = [s for s in order if s not in full and level * weight[s] > most * sizes[s]]
        if not above:
            return full | {s: level * weight[s] for s in order if s not in full}
        full |= {s: most * sizes[s] for s in above}


def draw(key, seed=8):
    return int(hashlib.md5(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:13], 16) / 2**52


@pytest.fixture(scope="module")
def rows():
    made = [(i, "w " * (i % 17), ["b", "a", "Z", "é", None][min(4, i % 9)], "x", 1) for i in range(400)]
    return made + [(7, "one\ttwo\x0bthree", "a", "x", 1)] * 2 + [(None, None, "b", "x", 1), (900, "", "empty", "x", 1)]


def test_report_agrees_with_plain_sharing(spark, rows):
    found = mixing.mixture_report(spark.createDataFrame(rows, SCHEMA)).collect()
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    targets = shares(sizes)
    expected = []
    for key, text, source, *_ in rows:
        rate = targets[source] / sizes[source] if sizes[source] else 0
        copies = math.floor(rate) + (draw(key) < rate - math.floor(rate))
        expected.append((key, words(text), sizes[source], round(targets[source], 6), words(text) * copies))
    got = [(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_taken_words_come_near_the_target(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 9 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
    )
    report = mixing.mixture_report(docs).withColumn("over", F.col("taken") > 2 * F.col("size"))
    sums = report.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("over").alias("over")).collect()
    assert all(r.taken == pytest.approx(r.target, rel=0.06) and not r.over for r in sums)


def test_mix_repeats_whole_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = {}
    for r in mixing.mixture_report(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + words(r.text)
    assert got == {k: v for k, v in taken.items() if k in got} and not any(v for k, v in taken.items() if k not in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mixture_report(docs).count() == 0 and mixing.mix(docs).count() == 0
