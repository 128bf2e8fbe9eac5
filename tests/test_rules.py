"""Rules against literal truth tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lapsewise import fixed_values as fv
from lapsewise.functions import amounts, dates, rules, text
from lapsewise.operators import lookups

SENIOR, CLASSIC = fv.SENIOR_FORMULA, fv.CLASSIC_FORMULA
NAN = float("nan")


def lit(value):
    if value is None:
        return F.lit(None).cast("double")
    return F.lit(value)


@pytest.fixture(scope="module")
def value(spark):
    """Value of one column expression."""
    return lambda column: spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "formula,age,expected", [(CLASSIC, 61, 1), (CLASSIC, 60, 0), (SENIOR, 61, 0), ("X", 90, 1), ("X", None, 0)]
)
def test_action1(value, formula, age, expected):
    assert value(rules.to_senior(F.lit(formula), lit(age))) == expected


def test_action1_without_formula(value):
    assert value(rules.to_senior(F.lit(None).cast("string"), F.lit(61))) == 1


@pytest.mark.parametrize(
    "formula,spent,age,expected",
    [(CLASSIC, 101, 60, 1), (CLASSIC, 100, 60, 0), (CLASSIC, 101, 61, 0), (SENIOR, 500, 30, 0), (CLASSIC, None, 30, 0)],
)
def test_action2(value, formula, spent, age, expected):
    assert value(rules.classic_upgrade(F.lit(formula), lit(spent), F.lit(age))) == expected


@pytest.mark.parametrize("formula,spent,expected", [(SENIOR, 251, 1), (SENIOR, 250, 0), (CLASSIC, 900, 0)])
def test_action3(value, formula, spent, expected):
    assert value(rules.senior_upgrade(F.lit(formula), F.lit(spent))) == expected


@pytest.mark.parametrize("a,b,c,expected", [(1, 0, 0, 1), (0, 2, 0, 1), (0, 0, 3, 1), (1, 1, 0, 0), (0, 0, 0, 0), (1, 1, 1, 0)])
def test_action5(value, a, b, c, expected):
    assert value(rules.single_family(F.lit(a), F.lit(b), F.lit(c))) == expected


@pytest.mark.parametrize(
    "formula,months,six,seven",
    [(SENIOR, 5, 0, 0), (SENIOR, 6, 1, 0), (CLASSIC, 29, 1, 0), (CLASSIC, 30, 0, 1), ("X", 40, 0, 0)],
)
def test_actions_6_and_7(value, formula, months, six, seven):
    assert value(rules.loyalty_one_year(F.lit(formula), F.lit(months))) == six
    assert value(rules.loyalty_three_years(F.lit(formula), F.lit(months))) == seven


@pytest.mark.parametrize(
    "flags,code,label",
    [
        ((0, 0, 0, 0), "0000", ""), ((0, 0, 0, 1), "0001", "Bonus fidélité"), ((0, 0, 1, 1), "0011", "Montée de produit"),
        ((0, 1, 0, 1), "0101", "Montée de produit"), ((1, 1, 1, 1), "1111", "Montée de formule"),
    ],
)
def test_action_ids_and_labels(value, flags, code, label):
    assert value(rules.action_id(*map(F.lit, flags))) == code
    assert value(rules.action_label(F.lit(code))) == label


@pytest.mark.parametrize(
    "action,product,proposed",
    [
        ("1000", "SATEI-FM02", "SATEI-FS03"), ("0100", "SATEI-FM02", "SATEI-FM03"), ("1100", "SATEI-FM06", "SATEI-FM06"),
        ("0100", "OLD", "SATEI-FM03"), ("0010", "SATEI-FS03", "SATEI-FS3P"), ("0010", "OLD", "SATEI-FS03"),
        ("0110", "OLD", "SATEI-FS03"), ("0000", "OLD", "OLD"), ("0001", "SATEI-FM01", "SATEI-FM01"),
    ],
)
def test_proposed_products(spark, action, product, proposed):
    df = spark.createDataFrame([(action, product, "texte")], "action string, product string, label string")
    row = lookups.add_ladder(df, "product", "label", "action").first()
    assert row.proposed_product == proposed
    if product == "OLD":
        assert (row.product_label, row.product_family) == ("texte (OLD)", "AUTRE")
    else:
        assert row.product_label.startswith("SANTEIS")


@pytest.mark.parametrize(
    "known,actual,simulated,flag",
    [
        (True, 100.0, 111.0, 1), (True, 100.0, 110.0, 0), (True, 20.0, 24.0, 0), (True, 0.0, 1.0, 1), (True, 0.0, 0.9, 0),
        (True, -5.0, 3.0, 1), (True, NAN, 2.0, 1), (True, 100.0, NAN, 0), (False, 100.0, 500.0, 0),
    ],
)
def test_atypical_simulations(value, known, actual, simulated, flag):
    assert value(rules.atypical_simulation(F.lit(known), F.lit(actual), F.lit(simulated))) == flag


def test_simulation_amounts(value):
    one, zero = F.lit(1), F.lit(0)
    assert value(rules.corrected_simulation(one, F.lit(5.0), F.lit(9.0))) == 5.0
    assert value(rules.corrected_simulation(zero, F.lit(5.0), F.lit(9.0))) == 9.0
    assert value(rules.failed_simulation_amount(zero, F.lit(5.0), F.lit("OK"))) == 0.0
    assert value(rules.failed_simulation_amount(zero, F.lit(5.0), F.lit("KO"))) == 5.0
    assert value(rules.failed_simulation_amount(one, F.lit(5.0), F.lit(None).cast("string"))) == 5.0


@pytest.mark.parametrize(
    "mobile,landline,expected",
    [(612345678.0, 123456789.0, "0612345678"), (NAN, 123456789.0, "0123456789"), (None, NAN, ""), (None, None, "")],
)
def test_phones(value, mobile, landline, expected):
    assert value(rules.phone(lit(mobile), lit(landline))) == expected


@pytest.mark.parametrize("probability,score", [(0.99, 10), (0.9, 10), (0.89, 9), (0.5, 8), (0.49, None), (NAN, None), (None, None)])
def test_score_ladder(value, probability, score):
    assert value(rules.score_on_ten(lit(probability), (0.9, 0.7, 0.5))) == score


def test_recodes(value):
    assert value(rules.regime(F.lit("Alsace Moselle"))) == "AM"
    assert value(rules.regime(F.lit(3))) == "AM"
    assert value(rules.regime(F.lit(None).cast("string"))) == "STEA"
    assert value(rules.legal_frame(F.lit("Fonctionnaire"))) == "F"
    assert value(rules.legal_frame(F.lit(4))) == "NF"


def test_health_scopes(spark):
    rows = [
        ("SANTéIS FORMULE 3S", None, None, None), ("SANTéIS FORMULE 2", "x", "A246", "460"), (None, "SANTEIS", "A241", "1"),
        ("FORMULE 5S", "SANTEIS", None, "1"), ("AUTO", "AUTO", "A000", "1"), (None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "lbproduit_cv string, lib_produit string, rlpcodc string, cdprodcdgauer string")
    got = [tuple(r[c] for c in fv.SCOPES) for r in rules.add_health_scopes(df).collect()]
    assert got == [
        (1, 0, 0, 0, 0, 0), (0, 1, 1, 1, 0, 0), (0, 1, 0, 0, 1, 0), (1, 0, 0, 0, 0, 0), (0, 0, 0, 0, 0, 1), (0, 0, 0, 0, 0, 1),
    ]


def test_dial_prefixes(spark):
    df = spark.createDataFrame([("1",), ("75",), ("97",), ("2A",), ("20",), ("0",), ("96",), (None,)], "d string")
    assert [r.indicatif for r in lookups.add_dial_prefix(df, "d").collect()] == ["04", "01", "-", "-", "04", "-", "-", "-"]


def test_price_grid(spark, rows_of):
    grid = spark.createDataFrame(
        [(1, 18, 39, "F1", 10.0), (1, 40, 80, "F2", 20.0), (2, 18, 80, "F3", 30.0)],
        "department int, age_min int, age_max int, formula string, price double",
    )
    df = spark.createDataFrame([(1, 39), (1, 40), (2, 18), (3, 50), (1, 81)], "dep int, age int")
    priced = lookups.add_price(df, grid, "age", "dep")
    assert rows_of(priced, "dep", "age", "formula", "price") == [
        (1, 39, "F1", 10.0), (1, 40, "F2", 20.0), (1, 81, None, None), (2, 18, "F3", 30.0), (3, 50, None, None),
    ]


def test_bands_without_ends(spark, rows_of):
    grid = spark.createDataFrame([(None, 9, "A", 1.0), (10, 29, "B", 2.0), (30, None, "C", 3.0)], "age_min int, age_max int, formula string, price double")
    df = spark.createDataFrame([(200.0,), (29.9,), (-3.0,), (float("nan"),), (None,)], "age double")
    found = {str(r.age): r.formula for r in lookups.add_price(df, grid, "age").collect()}
    assert found == {"200.0": "C", "29.9": "B", "-3.0": "A", "nan": None, "None": None}
    assert lookups.add_price(df, grid.limit(0), "age").where("formula is null").count() == 5


@pytest.mark.parametrize("amount,bucket", [(149.0, 100), (150.0, 150), (-1.0, -50), (NAN, 0), (None, 0)])
def test_buckets_go_down(value, amount, bucket):
    assert value(amounts.floor_to_step(lit(amount), 50)) == bucket


def test_rounding_is_half_to_even(value):
    assert value(amounts.percent(F.lit(25), F.lit(10000))) == 0.2
    assert value(amounts.percent(F.lit(1), F.lit(0))) is None
    assert value(text.compact_thousands(F.lit(2500.0))) == "2k"
    assert value(text.compact_thousands(F.lit(12400))) == "12k"
    assert value(amounts.monthly_amount(F.lit(-25.0))) == -2
    assert value(amounts.monthly_amount(F.lit(NAN))) == 0


def test_texts(value):
    assert value(text.zero_fill(F.lit("123456789"), 8)) == "123456789"
    assert value(text.zero_fill(F.lit(7), 2)) == "07"
    assert value(text.contract_key(F.lit("a"), F.lit("b"), F.lit(None).cast("string"))) is None
    assert value(text.policy_number(F.lit("12"), F.lit("07"), ("07",), 11)) == "00000000012"
    assert value(text.upper_or_empty(F.lit(None).cast("string"))) == ""
    assert value(text.rejoin(F.lit("a, b"))) == "a /  b"
    assert value(text.rejoin(F.lit("a, b"), trim=True)) == "a / b"
    assert value(text.measure_product(F.lit("nbCli_top"))) == ""
    assert value(text.stock_label(F.lit(2019), F.lit(12.0))) == "2019 (stock = 12)"


@pytest.mark.parametrize(
    "value_,month,day",
    [
        ("202012", True, False), ("20201", True, False), ("202013", False, False), ("20201231", False, True),
        ("20200230", False, False), ("2020-1-1", False, False), ("", False, False), (None, False, False), ("00001231", False, False),
    ],
)
def test_date_texts(value, value_, month, day):
    column = F.lit(value_).cast("string")
    assert value(dates.is_month_text(column)) is month
    assert value(dates.is_day_text(column)) is day
    six = month and len(value_) == 6
    for check, good in ((dates.check_month, six), (dates.check_day, day)):
        if good:
            assert check(value_) == value_
        else:
            with pytest.raises(ValueError):
                check(value_)


def test_calendars(spark, value):
    calendar = {r.month_id: r.date_ref for r in dates.quarter_calendar(spark).collect()}
    assert len(calendar) == 24
    assert (calendar[12], calendar[15], calendar[18], calendar[81]) == ("20161231", "20170331", "20170630", "20220930")
    df = spark.createDataFrame([("20170331",), ("20170401",), (None,)], "date_ref string")
    assert [r.month_id for r in dates.add_month_id(df).collect()] == ["15", "", ""]
    starts = value(dates.month_starts(F.lit("2019-11-20").cast("date"), 4))
    assert starts == ["20191101", "20191201", "20200101", "20200201"]
    assert value(dates.campaign_name(F.lit("2021-12-31").cast("date"), F.lit("3"))) == "OF_R2_MRH_Vague 2022 - S03"
    assert value(dates.month_key_of_number(dates.month_number(F.lit("2020-12-05").cast("date")))) == "202012"
