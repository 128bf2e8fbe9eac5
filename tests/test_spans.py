"""Month expansion and merged ends on hand-written contracts."""

from __future__ import annotations

from datetime import date

import pytest

from lapsewise.operators import spans

SCHEMA = "contract_id string, client_id bigint, start date, end date, network string"
D = date


@pytest.fixture(scope="module")
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def months(df, first="202001", last="202006"):
    return sorted((r.contract_id, r.month) for r in spans.expand_months(df, first, last).collect())


def test_both_ends_are_active_months_and_the_range_clips(frame):
    df = frame([("a", 1, D(2020, 2, 15), D(2020, 4, 1), "N"), ("b", 2, D(2019, 5, 1), D(2020, 1, 31), "N")])
    assert months(df) == [("a", "202002"), ("a", "202003"), ("a", "202004"), ("b", "202001")]


def test_open_and_unbounded_contracts_fill_the_range(frame):
    df = frame([("open", 1, D(2020, 5, 9), None, "N"), ("no_start", 2, None, D(2020, 2, 1), "N"), ("both", 3, None, None, "N")])
    got = months(df)
    assert [m for c, m in got if c == "open"] == ["202005", "202006"]
    assert [m for c, m in got if c == "no_start"] == ["202001", "202002"]
    assert len([m for c, m in got if c == "both"]) == 6


def test_reversed_and_outside_spans_have_no_month(frame):
    df = frame(
        [
            ("reversed", 1, D(2020, 5, 1), D(2020, 3, 1), "N"),
            ("before", 2, D(2018, 5, 1), D(2019, 12, 31), "N"),
            ("after", 3, D(2020, 7, 1), None, "N"),
            ("same_month", 4, D(2020, 3, 20), D(2020, 3, 10), "N"),
        ]
    )
    assert months(df) == [("same_month", "202003")]


def test_empty_spans_go_and_a_missing_start_with_an_end_goes_too(frame, rows_of):
    day = D(2020, 1, 1)
    df = frame([("zero", 1, day, day, "N"), ("open", 2, day, None, "N"), ("no_start", 3, None, day, "N"), ("real", 4, day, D(2020, 1, 2), "N")])
    assert [r[0] for r in rows_of(spans.drop_empty(df), "contract_id")] == ["open", "real"]


def test_versions_of_a_contract_share_the_latest_end(frame):
    df = frame(
        [
            ("replaced", 1, D(2020, 1, 1), D(2020, 2, 1), "N"),
            ("replaced", 1, D(2020, 2, 1), D(2020, 5, 1), "N"),
            ("reopened", 2, D(2020, 1, 1), D(2020, 2, 1), "N"),
            ("reopened", 2, D(2020, 3, 1), None, "N"),
        ]
    )
    exits = {(r.contract_id, r.exit_month, r.exit_year) for r in spans.monthly_portfolio(df, "202001", "202006").collect()}
    assert exits == {("replaced", "202005", "2020"), ("reopened", "999912", "9999")}


def test_versions_outside_the_range_do_not_move_the_end(frame):
    df = frame([("c", 1, D(2020, 1, 1), D(2020, 2, 1), "N"), ("c", 1, D(2021, 1, 1), D(2021, 9, 1), "N"), ("c", 1, D(2020, 8, 1), D(2020, 8, 1), "N")])
    assert {r.exit_month for r in spans.monthly_portfolio(df, "202001", "202006").collect()} == {"202002"}


def test_contracts_without_a_key_merge_as_one_group(frame):
    df = frame([(None, 1, D(2020, 1, 1), D(2020, 2, 1), "N"), (None, 2, D(2020, 1, 1), D(2020, 3, 1), "N")])
    assert {r.end for r in spans.merge_ends(df).collect()} == {D(2020, 3, 1)}
