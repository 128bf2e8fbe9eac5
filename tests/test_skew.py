"""Hot groups: same values as a window, rows spread, copies kept."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from lapsewise.operators import joins, skew, snapshots


@pytest.fixture(scope="module")
def skewed(spark):
    rows = [("hot", i % 7) for i in range(600)] + [(f"k{i % 40}", i) for i in range(400)] + [(None, i) for i in range(300)]
    return spark.createDataFrame(rows, "k string, v int").repartition(8)


def test_values_are_those_of_a_window(skewed, rows_of):
    ours = skew.attach_group(skewed, ["k"], [F.max("v").alias("top"), F.count("v").alias("n")])
    window = Window.partitionBy("k")
    plain = skewed.withColumn("top", F.max("v").over(window)).withColumn("n", F.count("v").over(window))
    assert rows_of(ours, "k", "v", "top", "n") == rows_of(plain, "k", "v", "top", "n")


def test_a_null_maximum_of_a_hot_group_stays_null(spark):
    df = spark.createDataFrame([("h", None)] * 100, "k string, v int")
    assert {r.top for r in skew.attach_group(df, ["k"], [F.max("v").alias("top")]).collect()} == {None}


@pytest.fixture
def eager_splits(spark):
    """Settings under which every shuffled partition above 1 KB counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_task_gets_a_whole_group_however_many_are_hot(spark, eager_splits):
    df = spark.range(60_000, numPartitions=8).select((F.col("id") % 2000).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    attached = skew.attach_group(df, ["k"], [F.max("v").alias("top")]).select("k", "top", F.spark_partition_id().alias("task"))
    rows = attached.collect()
    tasks, tops = {}, {}
    for k, top, task in rows:
        tasks.setdefault(k, set()).add(task)
        tops.setdefault(k, set()).add(top)
    assert len(rows) == 60_000 and len(tasks) == 2000
    assert min(len(t) for t in tasks.values()) > 1 and all(len(t) == 1 for t in tops.values())


def test_the_input_is_read_once_for_the_rows_and_once_for_the_groups(spark, tmp_path):
    spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for made in (skew.attach_group(df, ["k"], [F.max("v").alias("top")]), snapshots.keep_latest(df, ["k"], "v")):
        assert made._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2
    members = spark.range(5).select(F.col("id").alias("m"))
    marked = joins.mark_members(joins.mark_members(df, "k", members, "m", "a"), "k", members, "m", "b")
    assert marked._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1


def test_latest_version_keeps_ties_and_drops_unknown_versions(spark, rows_of):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", None, "z"), (None, 5, "w"), (None, 4, "v")],
        "k string, v int, t string",
    )
    kept = snapshots.keep_latest(df, ["k"], "v")
    assert rows_of(kept, "k", "t") == [("a", "y"), ("a", "y"), (None, "w")]


def test_first_row_per_key_is_cut_before_the_shuffle(skewed):
    first = snapshots.first_per_key(skewed, ["k"], [F.desc("v")], null_keys="group")
    assert first.count() == 42
    assert snapshots.first_per_key(skewed, ["k"], [F.desc("v")]).count() == 41 + 300
    assert snapshots.first_per_key(skewed, ["k"], [F.desc("v")], null_keys="drop").count() == 41
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_union_of_nothing_has_the_schema(spark):
    empty = snapshots.union_all(spark, [], "a int, b string")
    assert empty.count() == 0 and empty.columns == ["a", "b"]


def test_rows_attached_are_those_of_a_left_join(spark, skewed, rows_of):
    other = spark.createDataFrame([("hot", "H"), ("k1", "K"), (None, "N"), ("absent", "A")], "k string, t string")
    ours = skew.attach_row(skewed, other, ["k"])
    plain = skewed.alias("d").join(other.alias("o"), F.col("d.k").eqNullSafe(F.col("o.k")), "left").select("d.*", "t")
    assert rows_of(ours, "k", "v", "t") == rows_of(plain, "k", "v", "t")


def test_spark_splits_a_hot_reference_join_at_run_time(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(60_000, numPartitions=6).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("v")
        )
        joined = joins.add_reference(left, spark.range(40_000).select(F.col("id").alias("k"), F.lit(1).alias("t")), ["k"])
        assert len(joined.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_match_distinct_finds_copies_in_sorted_rows(spark, rows_of):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "b"), (3, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "z"), (None, "n"), (4, "u")], "k int, w string")
    matched = joins.match_distinct(left, right, ["k"])
    assert rows_of(matched) == sorted([(1, "a", "x"), (1, "a", "y"), (1, None, "x"), (1, None, "y"), (2, "b", "z")], key=lambda r: tuple((v is None, str(v)) for v in r))
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "HashAggregate" in line and "v#" in line]
