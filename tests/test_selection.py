"""Draws: order, ties, quotas, control groups, reuse."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lapsewise.operators import joins, quality, selection


@pytest.fixture(scope="module")
def scores(spark):
    pick = random.Random(5)
    rows = [(f"i{n:04d}", pick.choice([None, 7, 7, 7, 8, 9, 10]), pick.choice("AB")) for n in range(1500)]
    return rows, spark.createDataFrame(rows, "id string, score int, g string").repartition(7)


@pytest.mark.parametrize("n", [1, 50, 400, 1300, 5000])
def test_top_n_takes_the_first_rows(scores, n):
    rows, df = scores
    expected = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))[:n]
    order = [("score", "desc"), ("id", "asc")]
    assert [tuple(r) for r in selection.top_n(df, n, order).collect()] == expected


def test_top_n_has_one_plan_for_any_size(scores):
    def shape(n):
        lines = selection.top_n(scores[1], n, [("id", "asc")])._jdf.queryExecution().sparkPlan().toString().splitlines()
        return [line.strip(" :+-").split("(")[0].split(" ")[0] for line in lines]

    shapes = [shape(n) for n in (10, 1000, 1001, 100_000)]
    assert all(s == shapes[0] for s in shapes)


@pytest.mark.parametrize("partitions", [8, 64])
def test_no_task_merges_a_large_draw(spark, partitions):
    former = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(300_000).selectExpr("id", "id * 7919 % 300007 as score")
        order = [("score", "desc"), ("id", "asc")]
        ranged = selection._ranged(df, 100_000, order)
        assert ranged.count() == 100_000
        drawn = selection.top_n(df, 100_000, order)
        expected = sorted(((i * 7919 % 300007, i) for i in range(300_000)), reverse=True)[:100_000]
        assert {r.id for r in drawn.collect()} == {i for _, i in expected}
        # what meets in one task is a range of the positions, or one row for each range
        written = ranged._jdf.queryExecution().sparkPlan().toString()
        assert "TakeOrderedAndProject" not in written
        sizes = df.repartitionByRange(F.desc("score"), "id").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == partitions and max(r["count"] for r in sizes) < 3 * 300_000 / partitions
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", former)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_top_n_with_repeated_rows_is_exact(spark):
    df = spark.createDataFrame([("a", 1)] * 30 + [("b", 2)] * 5, "id string, score int")
    assert selection.top_n(df, 12, [("score", "desc"), ("id", "asc")]).count() == 12


@pytest.mark.parametrize("k", [1, 20, 300, 5000])
def test_ties_with_the_last_row_are_kept(scores, rows_of, k):
    rows, df = scores
    expected = []
    for group in "AB":
        known = sorted((r for r in rows if r[1] is not None and r[2] == group), key=lambda r: -r[1])
        limit = known[min(k, len(known)) - 1][1]
        expected += [r for r in known if r[1] >= limit]
    assert rows_of(selection.top_with_ties(df, k, [("score", "desc")], ["g"], slices=4)) == sorted(expected)


def test_control_group_has_the_size_asked_or_everyone(scores):
    _, df = scores
    assert selection.control_group(df, "id", 90).where("temoin").count() == 90
    assert selection.control_group(df, "id", 9000).where("temoin").count() == 1500
    again = selection.control_group(df.repartition(3), "id", 90).where("temoin").select("id")
    assert again.exceptAll(selection.control_group(df, "id", 90).where("temoin").select("id")).isEmpty()
    other = selection.control_group(df, "id", 90, seed=2).where("temoin").select("id")
    assert not other.exceptAll(again).isEmpty()


@pytest.fixture(scope="module")
def candidates(spark):
    rows = [
        (f"c{n:03d}", "-" if n % 5 else "DONE", "O" if n % 7 else "N", "GAV" if n % 3 else "GAV, AUTO", 60 + n % 30, n % 11)
        for n in range(300)
    ]
    return spark.createDataFrame(
        rows, "identifiant string, Contact string, Presence_CC string, proposition string, age_assure int, score int"
    )


def test_wave_takes_the_best_eligible_rows_and_a_disjoint_control_group(candidates):
    wave = selection.wave(candidates, [("score", "desc")], contacts=40, controls=10).collect()
    eligible = quality.apply_steps(candidates, selection.wave_steps()).collect()
    expected = sorted(eligible, key=lambda r: (-r.score, r.identifiant))[:50]
    assert {r.identifiant for r in wave} == {r.identifiant for r in expected}
    assert sum(r.temoin for r in wave) == 10
    assert len(selection.wave(candidates, [("score", "desc")]).collect()) == len(eligible)


def test_a_stored_list_is_drawn_again_as_it_was(candidates, rows_of):
    first = selection.draw_or_reuse(candidates, None, [("score", "desc")], contacts=30, controls=5)
    former = first.select(F.col("identifiant").alias("id_contrat"), "temoin")
    again = selection.draw_or_reuse(candidates, former, [("score", "desc")])
    assert rows_of(first, "identifiant", "temoin") == rows_of(again, "identifiant", "temoin")


def test_funnel_counts_every_step(candidates):
    steps = selection.wave_steps()
    df, expected = candidates, [candidates.count()]
    for step in steps.values():
        df = df.where(step)
        expected.append(df.count())
    table = sorted(quality.funnel(candidates, steps).collect())
    assert [r.rows for r in table] == expected
    assert [r.step for r in table] == ["start", *steps]


def test_funnel_counts_distinct_ids_of_every_step(spark, rows_of):
    rows = [("a", 1, 1), ("a", 1, 0), ("b", 0, 1), ("b", 1, 0), ("c", None, 1), (None, 1, 1), ("d", 1, 1)]
    df = spark.createDataFrame(rows, "id string, x int, y int")
    steps = {"x": F.col("x") == 1, "y": F.col("y") == 1}
    assert rows_of(quality.funnel(df, steps, ids="id")) == [(0, "start", 7, 4), (1, "x", 5, 3), (2, "y", 3, 2)]
    assert rows_of(quality.funnel(df.limit(0), steps, ids="id")) == [(0, "start", 0, 0), (1, "x", 0, 0), (2, "y", 0, 0)]


def test_anniversary_months_stay_between_1_and_12(spark):
    months = spark.range(1, 13).select("id", selection.anniversary_month(F.col("id")).alias("m")).collect()
    assert [r.m for r in months] == [6, 7, 8, 9, 10, 11, 12, 1, 2, 3, 4, 5]


@pytest.fixture(scope="module")
def dormant(spark):
    rows = [(f"d{n:03d}", 8, 12, None, 1, 0, "O", 6 if n % 2 else 1, n % 10) for n in range(60)]
    rows += [("leaving", 8, 12, 0.0, 1, 0, "O", 6, 99), ("new", 8, 6, None, 1, 0, "O", 6, 99), ("alone", 8, 12, None, 1, 0, "N", 6, 99)]
    rows += [("nan", 8, 12, float("nan"), 0, 1, "N", 6, 99)]
    return spark.createDataFrame(
        rows,
        "identifiant string, score_fragilite int, anciennete_contrat_mois int, nb_mois_depuis_resiliation double, "
        "actions_123 int, actions_67 int, Presence_CC string, mois_anniversaire int, score_model int",
    )


def test_waterfall_fills_from_the_second_bucket(dormant):
    drawn = selection.quota_waterfall(dormant, 40, F.lit(1)).collect()
    buckets = [r.bucket for r in drawn]
    assert buckets.count(1) == 31 and buckets.count(2) == 9
    assert drawn[0].identifiant == "nan"
    assert {r.identifiant for r in drawn}.isdisjoint({"leaving", "new", "alone"})


def test_waterfall_with_ties_takes_all_rows_of_the_last_score(dormant):
    drawn = selection.quota_waterfall(dormant, 3, F.lit(1), ties=True).collect()
    assert sorted(r.score_model for r in drawn) == [9] * 6 + [99]


def test_marks_never_multiply_rows_and_null_keys_stay(spark, rows_of):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    members = spark.createDataFrame([(1,), (1,), (None,)], "m int")
    marked = joins.mark_members(df, "id", members, "m", "x")
    assert rows_of(marked) == [(1, True), (2, False), (None, False)]
    assert rows_of(joins.exclude_members(df, "id", members, "m")) == [(2,), (None,)]
    assert rows_of(joins.keep_members(df, "id", members, "m")) == [(1,)]


def test_upper_key_join_leaves_the_other_side_unless_asked(spark, rows_of):
    left = spark.createDataFrame([("a@x",), (None,)], "mail string")
    right = spark.createDataFrame([("a@x", 1), ("A@X", 2)], "email string, n int")
    assert rows_of(joins.add_by_upper_key(left, "mail", right, "email"), "mail", "n") == [("", None), ("A@X", 2)]
    assert len(rows_of(joins.add_by_upper_key(left, "mail", right, "email", both_sides=True))) == 3


def test_repeated_keys_and_empty_frames_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        quality.assert_unique(df, ["k"])
    assert quality.assert_unique(df, ["k", "v"]) is df
    with pytest.raises(ValueError):
        quality.require_rows(df.where("k > 5"))
    assert quality.require_rows(df) is df
