"""Distinct counts against a plain Python reading of the rules."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from datetime import date, timedelta

import pytest

from lapsewise.operators import measures, spans
from lapsewise.plans.churn import churn_measures
from lapsewise.operators import kpis, reshape
from lapsewise.queries import QUERIES

SF = "/root/testdata/sf0.001"

SCHEMA = "contract_id string, client_id bigint, start date, end date, network string, f int, g int"
FLAGS = ["f", "g"]
D = date


def month(day):
    return day.year * 12 + day.month - 1


def key(number):
    return f"{number // 12:04d}{number % 12 + 1:02d}"


def by_hand(rows, first, last, period, flags):
    """Stock and terminations by (period, network) and measure."""
    low, high = (int(m[:4]) * 12 + int(m[4:]) - 1 for m in (first, last))
    active, ends = [], defaultdict(lambda: D(1, 1, 1))
    for row in rows:
        contract, _, start, end = row[:4]
        if end is not None and (start is None or start == end):
            continue
        a = max(low, month(start)) if start else low
        b = min(high, month(end)) if end else high
        if a <= b:
            active.append((row, a, b))
            ends[contract] = max(ends[contract], end or D(9999, 12, 1))
    stock, exits = defaultdict(set), defaultdict(set)
    for row, a, b in active:
        contract, client, _, _, network, *marks = row
        for m in range(a, b + 1):
            for flag, mark in zip(flags, marks):
                if mark == 1:
                    at = key(m) if period == "month" else key(m)[:4]
                    end = key(month(ends[contract]))
                    for kind, value in (("nbCli", client), ("nbCtr", contract)):
                        stock[at, network, f"{kind}_{flag}"].add(value)
                        exits[at, network, f"{kind}_{flag}"] |= {value} if at == (end if period == "month" else end[:4]) else set()
    return stock, exits


def counted(df, period):
    return {
        (r[period], r.network, name): r[name]
        for r in df.collect()
        for name in df.columns
        if name.startswith("nb") and r[name] is not None
    }


def sizes(sets):
    return {k: len({v for v in values if v is not None}) for k, values in sets.items()}


def random_rows(seed, n=400):
    pick = random.Random(seed)
    rows = []
    for _ in range(n):
        start = D(2012, 1, 1) + timedelta(days=pick.randrange(3500)) if pick.random() > 0.05 else None
        end = (start or D(2015, 1, 1)) + timedelta(days=pick.randrange(-40, 900)) if pick.random() > 0.3 else None
        contract = f"c{pick.randrange(150)}" if pick.random() > 0.03 else None
        rows.append((contract, pick.randrange(80), start, end, pick.choice(["A", "B"]), pick.randrange(2), pick.randrange(2)))
    return rows


RANGES = [("201301", "201312"), ("201206", "202012"), ("201501", "201501")]


@pytest.mark.parametrize("first,last", RANGES)
@pytest.mark.parametrize("period", ["month", "year"])
def test_counts_match_plain_reading(spark, first, last, period):
    rows = random_rows(hash((first, period)) % 1000)
    df = spark.createDataFrame(rows, SCHEMA)
    stock, exits = by_hand(rows, first, last, period, FLAGS)
    monthly = spans.monthly_portfolio(df, first, last)
    if period == "month":
        assert counted(measures.stock(monthly, FLAGS), "month") == sizes(stock)
        assert counted(measures.stock_of_spans(df, first, last, FLAGS), "month") == sizes(stock)
    assert counted(measures.terminations(monthly, period, FLAGS), period) == sizes(exits)
    assert counted(measures.terminations_of_spans(df, first, last, period, FLAGS), period) == sizes(exits)


@pytest.mark.parametrize("first,last", RANGES)
def test_lists_of_months_match_plain_reading(spark, first, last):
    rows = random_rows(len(first + last) + int(last))
    df = spark.createDataFrame(rows, SCHEMA)
    stock, exits = by_hand(rows, first, last, "month", FLAGS)
    listed = spans.listed_portfolio(df, first, last)
    assert counted(measures.stock(listed, FLAGS), "month") == sizes(stock)
    assert counted(measures.stock(spans.list_months(spans.drop_empty(df), first, last), FLAGS), "month") == sizes(stock)
    assert counted(measures.terminations(listed, "month", FLAGS), "month") == sizes(exits)
    kept = measures.terminations(listed, "month", FLAGS, sentinel=True)
    expanded = measures.terminations(spans.monthly_portfolio(df, first, last), "month", FLAGS, sentinel=True)
    assert sorted(map(str, kept.collect())) == sorted(map(str, expanded.collect()))
    with pytest.raises(ValueError):
        measures.terminations(listed, "year", FLAGS)


@pytest.mark.parametrize("name", ["terminations_sentinel_compat", "stock_by_network_product_expanded", "stock_theta"])
def test_ids_are_shuffled_without_their_months(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    ids = [keys for keys in re.findall(r"hashpartitioning\(([^)]*)\)", plan) if "id#" in keys and "kind#" in keys]
    assert ids and not any("month#" in keys for keys in ids)


def test_churn_rates_read_stored_spans(spark):
    files = QUERIES["churn_rate_monthly"](spark, SF).inputFiles()
    assert any("/stock/" in f for f in files) and not any(".parquet" in f and f.startswith(f"file://{SF}") for f in files)


def test_hot_contracts_give_the_same_counts(spark, rows_of):
    rows = random_rows(3) + [("hot", i % 50, D(2013, 1, 1), D(2014, 5, 1 + i % 20), "A", 1, 0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    exits = measures.terminations_of_spans(df, "201301", "201512", "month", FLAGS)
    expanded = measures.terminations(spans.monthly_portfolio(df, "201301", "201512"), "month", FLAGS)
    assert rows_of(exits, *expanded.columns) == rows_of(expanded)


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [
            ("a", 1, D(2020, 1, 1), D(2020, 2, 10), "N", 1, 0),
            ("a", 1, D(2020, 2, 10), D(2020, 3, 10), "N", 1, 0),
            ("b", 1, D(2020, 1, 1), None, "N", 1, 0),
            ("c", 0, D(2020, 2, 1), D(2020, 2, 20), "M", 0, 1),
        ],
        SCHEMA,
    )


def test_no_row_is_null_and_no_exit_is_zero(small, rows_of):
    table = measures.terminations_of_spans(small, "202001", "202003", "month", FLAGS)
    assert rows_of(table, "month", "network", "nbCtr_f", "nbCtr_g") == [
        ("202001", "N", 0, None), ("202002", "M", None, 1), ("202002", "N", 0, None), ("202003", "N", 1, None),
    ]


def test_sentinel_counts_one_more_where_a_contract_stays(small, rows_of):
    monthly = spans.monthly_portfolio(small, "202001", "202003")
    plain = measures.terminations(monthly, "month", ["f"])
    kept = measures.terminations(monthly, "month", ["f"], sentinel=True)
    assert rows_of(plain, "month", "network", "nbCtr_f") == [
        ("202001", "N", 0), ("202002", "M", None), ("202002", "N", 0), ("202003", "N", 1),
    ]
    assert rows_of(kept, "month", "network", "nbCtr_f") == [
        ("202001", "N", 1), ("202002", "M", None), ("202002", "N", 1), ("202003", "N", 2),
    ]


def test_an_exit_after_the_last_month_counts_for_its_year(spark):
    rows = [("a", 1, D(2020, 1, 1), D(2020, 11, 5), "N", 1, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    by_year = measures.terminations_of_spans(df, "202001", "202006", "year").first()
    assert (by_year.year, by_year.nbCtr) == ("2020", 1)
    assert {r.nbCtr for r in measures.terminations_of_spans(df, "202001", "202006").collect()} == {0}


def test_long_measures_and_back(small, rows_of):
    wide = measures.stock_of_spans(small, "202001", "202003", ["f"]).withColumnRenamed("nbCtr_f", "nbCtr_top_x_y")
    long = reshape.to_long(wide.drop("nbCli_f"), "stock")
    row = long.where("month = '202001'").first()
    assert (row["kind"], row["product"], row["year"], row["month_name"]) == ("nbCtr", "x_y", "2020", "Jan")
    back = reshape.to_wide(long, ["month", "network"], ["nbCtr_top_x_y"], "stock")
    assert rows_of(back, "month", "network", "nbCtr_top_x_y") == rows_of(
        wide.where("nbCtr_top_x_y is not null"), "month", "network", "nbCtr_top_x_y"
    )


def test_fused_measures_equal_the_join_of_both_reports(small, rows_of):
    stock = reshape.to_long(measures.stock_of_spans(small, "202001", "202003", FLAGS), "stock")
    left = reshape.to_long(measures.terminations_of_spans(small, "202001", "202003", "month", FLAGS), "terminated")
    joined = kpis.monthly_rates(stock, left)
    fused = churn_measures(small, "202001", "202003", FLAGS)
    columns = ["month", "network", "name", "kind", "product", "year", "stock", "terminated", "rate"]
    assert rows_of(joined, *columns) == rows_of(fused, *columns)
