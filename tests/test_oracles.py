"""Every named query gives the rows of its SQL."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lapsewise.queries import QUERIES
from tools.check_oracles import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    sql = oracle_sql().get(name)
    assert sql, "every query so far can be said in SQL"
    _, _, verdict = compare(spark, duck, name, queries()[name], sql, SF_DIR)
    assert verdict == "ok"


def test_entry_has_rows(spark):
    assert not entry(spark).isEmpty()


def test_names_of_queries_and_sql_match():
    assert set(oracle_sql()) <= set(queries())
