"""Every corpus query is registered and agrees with its SQL, or with the operator's own tests' plain reading."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from lapsewise.llm import bpe, token_store
from lapsewise.llm.queries import ORACLES, QUERIES
from tests.llm import test_negatives, test_periodic, test_piecewise
from tests.llm.test_repeats import plain_report
from tests.llm.test_simhash import plain_classes, plain_print
from tools.check_oracles import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.fixture(scope="module")
def documents(duck):
    return duck.sql("select doc_id, text from documents order by doc_id").fetchall()


def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], SF_DIR)[2] == "ok"


def rows(spark, name, *columns):
    return sorted(tuple(r) for r in QUERIES[name](spark, SF_DIR).select(*columns).collect())


def test_op1(spark, documents):
    prints = [plain_print(t) for _, t in documents]
    classes, first = plain_classes(prints), {}
    for (key, _), p in zip(documents, prints, strict=True):
        first[classes[p]] = min(key, first.get(classes[p], key))
    expected = [(k, f"{p:016x}", first[classes[p]]) for (k, _), p in zip(documents, prints, strict=True)]
    assert rows(spark, "op1_simhash", "doc_id", "fingerprint", "component_id") == expected


def test_op3(spark, documents):
    with open(public_tokenizers.path(bpe.RANKS), "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    encoding, expected = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), []
    for key, text in documents:
        ids = np.array(encoding.encode_ordinary(text or ""), "<u4")
        expected.append((key, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert rows(spark, "op3_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected


def test_op9(spark, documents):
    tokenizer, expected, at = Tokenizer.from_file(public_tokenizers.path(token_store.TOKENIZER)), [], 0
    for key, text in documents:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        expected.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert rows(spark, "op9_token_store", "doc_id", "start", "n_tokens", "ids_crc32") == expected


def test_op10(spark, documents):
    assert rows(spark, "op10_repeats", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(plain_report(documents))


def test_op11(spark, duck):
    vectors = duck.sql("select vec_id, label, embedding from embeddings").fetchall()
    expected = test_negatives.plain(test_negatives.taking_part(vectors))
    assert len(expected) > 100
    assert rows(spark, "op11_hard_negatives", "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") == expected


def test_op12(spark, documents):
    got = rows(spark, "op12_fingerprints", "*")
    assert got == sorted(test_piecewise.plain_report(documents))
    assert sum(r[5] > r[6] for r in got) > 0.95 * len(got)


def test_op13(spark, documents):
    got = rows(spark, "op13_periodic", "*")
    assert got == sorted(test_periodic.plain_report(documents)) and sum(r[1] > 0 for r in got) > 10
