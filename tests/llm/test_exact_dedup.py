from __future__ import annotations

import hashlib
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lapsewise.llm import exact_dedup
from lapsewise.sources.workspace import Scratch

SCHEMA = "doc_id bigint, text string, digest int, __n int"
ROWS = [
    (5, "a  b\n", 1, 1), (3, "a b ", 1, 1), (9, "a\tb\x0b", 1, 1), (4, None, 1, 1), (6, "", 1, 1), (8, " ", 1, 1), (10, "\n\n", 1, 1),
    (11, "a b", 1, 1), (12, "a\xa0b", 1, 1), (13, "long " * 50_000, 1, 1), (14, "long\t" * 50_000, 1, 1), (15, "long " * 50_000 + "x", 1, 1),
    (16, "twice", 1, 1), (16, "twice", 1, 1), (17, "twice", 1, 1), (None, "no id", 1, 1), (18, "no id", 1, 1), (None, "none", 1, 1), (None, "none", 1, 1),
]


def plain(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def groups(rows):
    found = {}
    for key, text, *_ in rows:
        found.setdefault(plain(text), []).append(key)
    return found


def report(rows):
    out = []
    for key, text, *_ in rows:
        ids = groups(rows)[plain(text)]
        out.append((key, min((i for i in ids if i is not None), default=None), len(ids), hashlib.sha256(plain(text).encode()).hexdigest()))
    return sorted(out, key=str)


def test_report_agrees_with_grouping(spark):
    got = exact_dedup.dedup_report(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == report(ROWS)
    assert sum(r.kept for r in got) == len(groups(ROWS))
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("digits", [0, 1])
def test_bytes_decide_when_digests_collide(spark, digits):
    def weak(text):
        return F.substring(exact_dedup.sha256(text), 1, digits)

    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = exact_dedup.verdicts(docs, Scratch(spark, "weak"), digest=weak).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, bytes(r.sha).hex()) for r in got), key=str) == report(ROWS)
    assert sum(r.kept for r in got) == len(groups(ROWS))


def test_state_grows_over_batches_and_runs(spark):
    scratch = Scratch(spark, "runs")
    own, parts = exact_dedup.state_session(spark), (ROWS[:9], ROWS[9:])
    for part in parts:  # one file a batch; the second run goes on from the state of the first
        exact_dedup.write_arrivals(spark.createDataFrame(part, SCHEMA).repartition(3), scratch.path("in"), "text", "doc_id", exact_dedup.sha256)
        exact_dedup.run_stream(own, scratch.path("in"), scratch.path("state"), files_a_batch=1)
    entries = exact_dedup.read_state(own, scratch.path("state")).collect()
    expected = sorted((min((i for i in ids if i is not None), default=exact_dedup.LAST), len(ids)) for ids in groups(ROWS).values())
    assert sorted((r.first_id, r.group_size) for r in entries) == expected


def test_dedup_keeps_one_whole_row_of_each_group(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, plain(r.text)) for r in kept.collect()]
    assert sorted(got, key=str) == sorted(((min((i for i in ids if i is not None), default=None), t) for t, ids in groups(ROWS).items()), key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.dedup_report(docs).count() == 0 and exact_dedup.dedup(docs).count() == 0


def test_a_store_goes_on_over_calls(spark):
    scratch = Scratch(spark, "calls")
    store = scratch.path("store")
    for i, part in enumerate((ROWS[:9], ROWS[9:], ROWS[9:], ROWS[:1] + [(2, "a b ", 1, 1), (99, "new", 1, 1)])):
        batch = "second" if i in (1, 2) else None  # the third call repeats the second batch, which counts once
        exact_dedup.add_documents(spark.createDataFrame(part, SCHEMA).repartition(2), store, batch=batch)
    every = [*ROWS, ROWS[0], (2, "a b ", 1, 1), (99, "new", 1, 1)]
    got = exact_dedup.store_verdicts(spark, store, Scratch(spark, "verdicts")).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, bytes(r.sha).hex()) for r in got), key=str) == report(every)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.sha for r in kept}) == len(groups(every))
    assert all(r.id == r.keep_id for r in kept) and len({(r.file, r.place) for r in got}) == len(every)


def test_locators_lead_to_the_bytes(spark):
    scratch = Scratch(spark, "located")
    exact_dedup.add_documents(spark.createDataFrame(ROWS, SCHEMA).repartition(3), scratch.path("store"))
    own = exact_dedup.state_session(spark)
    for r in exact_dedup.read_state(own, scratch.path("store/state")).collect():
        row = pq.read_table(f"{scratch.path('store/content')}/{r.keep_file}").to_pylist()[r.keep_place]
        assert (exact_dedup.LAST if row["id"] is None else row["id"]) == r.first_id
        assert hashlib.sha256(plain(row["row"]["text"]).encode()).digest() == bytes(r.digest)


def test_a_batch_cut_short_is_not_read(spark):
    scratch = Scratch(spark, "cut")
    docs = spark.createDataFrame(ROWS, SCHEMA)
    docs.selectExpr("cast(text as binary) digest", "doc_id id").write.parquet(f"{scratch.path('store')}/content-incoming/first")
    exact_dedup.add_documents(docs, scratch.path("store"), batch="first")
    assert exact_dedup.store_verdicts(spark, scratch.path("store"), Scratch(spark, "verdicts")).count() == len(ROWS)
    with pytest.raises(ValueError, match="batch"):
        exact_dedup.add_documents(docs, scratch.path("store"), batch="../x")


def test_dedup_when_digests_collide(spark):
    got = exact_dedup.dedup(spark.createDataFrame(ROWS, SCHEMA), digest=lambda text: F.substring(exact_dedup.sha256(text), 1, 1))
    got = [(r.doc_id, plain(r.text)) for r in got.collect()]
    assert sorted(got, key=str) == sorted(((min((i for i in ids if i is not None), default=None), t) for t, ids in groups(ROWS).items()), key=str)
