"""The pipeline against a plain reading of each stage."""

from __future__ import annotations

import hashlib
import math
import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from lapsewise.llm import bpe, quality
from tests.llm.test_mixing import draw, shares, words
from tests.llm.test_similar import plain_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain(spark):
    """Rows of each stage, from the rows of ``documents`` and the classifier's verdicts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdicts = {r.doc_id: r.predicted for r in quality.quality_report(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    good = [tuple(r) for r in docs.collect() if verdicts[r.doc_id]]
    first = {}
    for row in good:
        digest = hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", row[1] or "").encode()).digest()
        first[digest] = min(first.get(digest, row), row)
    single = sorted(first.values())
    groups, kept = plain_groups([r[1] for r in single]), {}
    for at, row in enumerate(single):
        kept[groups[at]] = min(kept.get(groups[at], row), row)
    apart, sizes = sorted(kept.values()), {}
    for row in apart:
        sizes[row[3]] = sizes.get(row[3], 0) + words(row[1])
    targets, mixed = shares(sizes), []
    for row in apart:
        rate = targets[row[3]] / sizes[row[3]] if sizes[row[3]] else 0
        mixed += [row] * (math.floor(rate) + (draw(row[0]) < rate - math.floor(rate)))
    return [good, single, apart, mixed]


def test_stages_one_by_one(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], plain, strict=True):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert sorted(map(tuple, out.collect())) == sorted(expected), name
        docs = spark.createDataFrame(expected, docs.schema)


def test_whole_run(spark, plain):
    with open(public_tokenizers.path(bpe.RANKS), "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for key, text, _, source, _ in plain[-1]:
        ids = encoding.encode_ordinary(text or "")
        expected.append((key, source, len(ids), ids))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.source, r.n_tokens, list(r.token_ids)) for r in got) == sorted(expected)


def test_odd_rows_pass_all_stages(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, `__n` int"
    rows = [(1, None, None, None, None, 1, 1), (2, "", "en", "a", 0, 1, 1), (2, "", "en", "a", 0, 1, 1), (None, "some words in a row", "en", "b", 1, 1, 1)]
    rows += [(3, "word " * 50_000, None, "b", 1, 1, 1), (4, "word " * 50_000, None, "b", 1, 1, 1), (5, "other words that stand alone", None, "b", 1, 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), schema)
    ids = {r.doc_id for r in docs.collect()}
    assert 4 not in ids and {None, 3, 5} & ids
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0
