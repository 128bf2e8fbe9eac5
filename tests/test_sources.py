"""Tables, files, contact history, sinks and the shared folder."""

from __future__ import annotations

from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import Observation

from lapsewise.operators import scoring
from lapsewise.plans import churn, contacts
from lapsewise.sources import files, sinks, tables, workspace


@pytest.fixture(scope="module")
def shop(spark):
    spark.sql("create database if not exists shop")
    rows = [("202001", "a", 1, "alpha"), ("202001", "a", 2, "alps"), ("202001", "b", 1, "beta"), ("202002", "a", 9, "alto")]
    df = spark.createDataFrame(rows, "dt_partition string, k string, lot int, label string")
    df.write.mode("overwrite").partitionBy("dt_partition").saveAsTable("shop.cv_sales_contrat")
    df.write.mode("overwrite").saveAsTable("shop.cv_sales_produit")
    return "shop"


def test_snapshots_prune_partitions(spark, shop, rows_of):
    df = tables.read_snapshot(spark, "shop.cv_sales_contrat", 202001)
    assert rows_of(df, "k", "lot") == [("a", 1), ("a", 2), ("b", 1)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt_partition" in plan


def test_loader_filters_renames_and_keeps_the_latest(spark, shop, rows_of):
    seen = Observation("rows")
    df = tables.load_table(
        spark, shop, "cv_sales_contrat", ["k_sale", "lot", "label_sale"],
        equals={"dt_partition": "202001"}, contains={"label": "al"}, suffixed=["k", "label"], suffix="sale",
        latest_by=(["k_sale"], "lot"), observation=seen,
    )
    assert rows_of(df) == [("a", 2, "alps")]
    assert seen.get == {"rows": 1}


def test_one_table_must_match_the_name_parts(spark, shop):
    assert tables.find_table(spark, shop, "sales", "contrat") == "cv_sales_contrat"
    with pytest.raises(LookupError, match="several"):
        tables.find_table(spark, shop, "sales")
    with pytest.raises(LookupError, match="no table"):
        tables.find_table(spark, shop, "nothing")


def test_ids_of_lists_keep_their_zeros(spark, tmp_path, rows_of):
    lists = spark.createDataFrame([("00000012", 7)], files.CONTACT_SCHEMA)
    path = str(tmp_path / "list")
    sinks.write_csv(lists, path)
    assert rows_of(files.read_delimited(spark, path, files.CONTACT_SCHEMA)) == [("00000012", 7)]


def test_contact_history_reads_nine_month_ends(spark, tmp_path, rows_of):
    path = str(tmp_path / "lists")
    for n, end in enumerate(["2021-07-31", "2021-08-31", "2022-03-31", "2022-04-30", "2022-05-31", "2022-04-15"]):
        lists = spark.createDataFrame([(f"0000000{n}", 7 + n % 4)], files.CONTACT_SCHEMA)
        sinks.write_contact_list(lists, path, "home" if n % 2 else "health", "temoin" if n == 3 else "contact", end)
    extra = spark.createDataFrame([("00000003", 9)], files.CONTACT_SCHEMA)
    history = files.recent_contacts(files.read_contact_lists(spark, path), "20220430", extra=[extra])
    assert rows_of(history, "identifiantrce") == [("00000001",), ("00000002",), ("00000003",), ("00000003",)]
    written = str(tmp_path / "history")
    contacts.write_contact_history(files.read_contact_lists(spark, path), "20220430", written, extra=[extra])
    assert rows_of(files.read_delimited(spark, written, files.HISTORY_SCHEMA)) == rows_of(history)
    with pytest.raises(ValueError):
        files.recent_contacts(history, "202204")


def test_contact_history_reads_only_its_months(spark, tmp_path):
    path = str(tmp_path / "lists")
    sinks.write_contact_list(spark.createDataFrame([("1", 7)], files.CONTACT_SCHEMA), path, "home", "contact", "2022-04-30")
    plan = files.recent_contacts(files.read_contact_lists(spark, path), "20220430")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(month_end" in plan.toString()


def test_runs_are_appended(spark, tmp_path, rows_of):
    df = spark.createDataFrame([(1.0, 2.0, "x"), (3.0, 3.0, "x"), (5.0, None, "y")], "y double, prediction double, s string")
    metrics = scoring.regression_metrics(df, "y")
    path = str(tmp_path / "runs")
    for params in ("a", "b"):
        sinks.append_run(spark, path, ["v1", "v2"], params, metrics, metrics, metrics, datetime(2022, 1, 2, 3, 4, 5))
    runs = spark.read.parquet(path)
    assert rows_of(runs, "Date", "Variables", "Params") == [
        ("2022_01_02-03_04_05", "v1/v2", "a"), ("2022_01_02-03_04_05", "v1/v2", "b"),
    ]
    assert {r.Dev_mse for r in runs.collect()} == {0.5}


def test_metrics_are_those_of_the_textbook(spark):
    pairs = [(1.0, 1.5), (2.0, 1.0), (4.0, 4.5), (8.0, 6.0)]
    row = scoring.regression_metrics(spark.createDataFrame(pairs, "y double, prediction double"), "y").first()
    mean = sum(y for y, _ in pairs) / 4
    mse = sum((y - p) ** 2 for y, p in pairs) / 4
    assert row.mse == pytest.approx(mse) and row.rmse == pytest.approx(mse**0.5)
    assert row.mae == pytest.approx(1.0)
    assert row.r2 == pytest.approx(1 - 4 * mse / sum((y - mean) ** 2 for y, _ in pairs))
    assert row.explained_variance == pytest.approx(sum((p - mean) ** 2 for _, p in pairs) / 4)


def test_features_fill_missing_values(spark, rows_of):
    df = spark.createDataFrame([("a", 1.0, 1), (None, float("nan"), 0), ("b", None, 1)], "c string, n double, y int")
    assert rows_of(scoring.feature_frame(df, ["c"], ["n"], ["y"])) == [("NULL", 0.0, 0), ("a", 1.0, 1), ("b", 0.0, 1)]
    assert scoring.feature_frame(df, ["c"], ["n"], extra=["y"]).columns == ["c", "n", "y"]


def test_stored_frames_land_in_the_shared_folder(spark, rows_of):
    df = spark.createDataFrame([(1, date(2020, 1, 1))], "a int, d date")
    kept = workspace.stored(df, "frame")
    assert rows_of(kept) == rows_of(df) and kept.schema == df.schema
    folder = spark.sparkContext.getConf().get(workspace.SETTING)
    assert all(folder in f for f in kept.inputFiles())


def test_a_cluster_without_a_shared_folder_is_an_error():
    unset = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *_: None),
        sparkContext=SimpleNamespace(master="yarn", getConf=lambda: SimpleNamespace(get=lambda _: None)),
    )
    with pytest.raises(ValueError):
        workspace.shared_folder(unset)


def test_churn_reports_are_written_unless_nothing_is_active(spark, tmp_path):
    rows = [("a", 1, date(2020, 1, 1), date(2020, 2, 10), "N", 1)]
    schema = "contract_id string, client_id bigint, start date, end date, network string, f int"
    portfolio = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "r")
    churn.write_churn_report(portfolio, "202001", "202003", ["f"], path)
    assert files.read_frame(spark, f"{path}/report={churn.STOCK}").count() == 2
    with pytest.raises(ValueError):
        churn.write_churn_report(portfolio, "202101", "202103", ["f"], path)


def test_advisor_file(spark, tmp_path, rows_of):
    path = tmp_path / "RSG.csv"
    path.write_text("Nom;Prénom;Adresse mail\nDUPONT;Zoé;Z@X.FR\n", encoding="utf-8")
    assert rows_of(files.read_advisors(spark, str(path))) == [("DUPONT", "Zoé", "Z@X.FR")]


def test_rolling_reader_tells_missing_from_unreadable(spark, tmp_path, rows_of, monkeypatch):
    path = str(tmp_path / "rolling")
    for month, rows in (("2021-12-31", [("00000001", 7)]), ("2021-10-31", [("00000002", 8)]), ("2021-03-31", [("00000003", 9)])):
        sinks.write_contact_list(spark.createDataFrame(rows, files.CONTACT_SCHEMA), path, "of", "contact", month)
    broken = tmp_path / "rolling" / "campaign=of" / "role=temoin" / "month_end=2021-10-31"
    broken.mkdir(parents=True)
    (broken / "list.csv").write_text("NOGPA,note_fragilite\n00000004,nine\n,5\n00000005,6\n")
    history, report = files.rolling_contacts(spark, path, "20211231")
    assert rows_of(history) == [("00000001", 7), ("00000002", 8), ("00000004", None), ("00000005", 6)]
    states = {str(r.month_end): (r.state, r.files, r.rows, r.malformed) for r in report.collect()}
    assert len(states) == 9 and "2021-03-31" not in states
    assert (states["2021-12-31"][0], *states["2021-12-31"][2:]) == ("present", 1, 0) and states["2021-11-30"] == ("missing", 0, 0, 0)
    assert (states["2021-10-31"][0], *states["2021-10-31"][2:]) == ("present", 4, 1)
    assert [str(d) for d in files.month_ends("20240331", 3)] == ["2024-03-31", "2024-02-29", "2024-01-31"]
    empty, none = files.rolling_contacts(spark, str(tmp_path / "nowhere"), "20211231")
    assert empty.count() == 0 and {r.state for r in none.collect()} == {"missing"}
    listed = files.list_months
    monkeypatch.setattr(files, "list_months", lambda *a: {**listed(*a), date(2021, 12, 31): ("unreadable", ["x"])})
    with pytest.raises(OSError, match="2021-12-31"):
        files.rolling_contacts(spark, path, "20211231")
