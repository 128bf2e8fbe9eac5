"""KPIs on a small long frame."""

from __future__ import annotations

import pytest

from lapsewise.operators import kpis

SCHEMA = "month string, network string, name string, kind string, product string, year string, month_name string, stock bigint, terminated bigint, rate double"


@pytest.fixture(scope="module")
def series(spark):
    rows = []
    for year in (2019, 2020, 2021):
        for m in range(1, 13 if year < 2021 else 4):
            stock, left = 1000 + 10 * m, {2019: 5, 2020: m, 2021: 2 * m}[year]
            name = kpis.fv.MONTH_NAMES[m - 1]
            rows.append((f"{year}{m:02d}", "A", "nbCtr_top_x", "nbCtr", "x", str(year), name, stock, left, left / stock))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_annual_rate_uses_the_first_stock(series, rows_of):
    got = rows_of(kpis.annual_rates(series), "year", "stock", "terminated", "annual_rate")
    assert got == [("2019", 1010, 60, 5.9), ("2020", 1010, 78, 7.7), ("2021", 1010, 12, 1.2)]


@pytest.mark.parametrize("last", [None, "202103"])
def test_this_year_scaled_by_last_years_share(series, last):
    assert kpis.year_to_date_share(series, last).first().share == pytest.approx(6 / 78)
    row = kpis.annualised_rates(series, last).first()
    assert (row.year, row.annualised_rate) == ("2021", round(1.2 / (6 / 78), 1))


@pytest.mark.parametrize("last", [None, "202103"])
def test_selection_kpis(series, last):
    row = kpis.selection_kpis(series, "2019", last).first()
    assert (row.rate_base, row.rate_last, row.rate_this) == (5.9, 7.7, round(12 * 78 / 6 / 1010 * 100, 1))


def test_tables(series):
    table = {r.year: r for r in kpis.terminations_table(series).collect()}
    assert set(table) == {"2020", "2021"}
    assert (table["2020"]["Dec"], table["2021"]["Avr"], table["2021"]["Mar"]) == (12.0, None, 6.0)
    assert table["2020"]["label"] == "2020 (stock = 1010)"
    years = kpis.stock_per_year(kpis.annual_rates(series), ["2019", "2020", "2021"]).first()
    assert years["2019"] == "1k"
    assert kpis.rate_per_year(kpis.annual_rates(series), ["2020"]).first()["2020"] == 7.7


def test_two_years_in_order(series):
    months = [r.month for r in kpis.two_year_series(series).collect()]
    assert months == sorted(months) and months[0] == "202001" and len(months) == 15


def test_no_stock_gives_no_rate(spark):
    stock = spark.createDataFrame([("202001", "A", "n", 0)], "month string, network string, name string, stock bigint")
    left = spark.createDataFrame([("202001", "A", "n", 3)], "month string, network string, name string, terminated bigint")
    assert kpis.monthly_rates(stock, left).first().rate is None
