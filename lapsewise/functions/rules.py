"""Segmentation, recoding and cleaning rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from lapsewise import fixed_values as fv
from lapsewise.functions.amounts import flag, gap, gap_percent, nan_to_null


def add_flags(df: DataFrame, rules: Mapping[str, Column], other: str | None = None) -> DataFrame:
    """One 0/1 column per rule, in order, so that a rule may use the flags before it.

    ``other`` names the flag of rows for which no rule holds.
    """
    for name, condition in rules.items():
        df = df.withColumn(name, flag(condition))
    if other:
        none = F.greatest(*[F.col(n) for n in rules], F.lit(0)) == 0
        df = df.withColumn(other, flag(none))
    return df


def health_scope_rules() -> dict[str, Column]:
    """Rules of the individual-health scopes, for :func:`add_flags`."""
    line = F.col("lbproduit_cv").rlike(fv.LINE_PATTERN_COLLECTOR) | F.col("lib_produit").rlike(fv.LINE_PATTERN_BASE)
    senior, classic, single, self_employed, private, _ = fv.SCOPES
    return {
        senior: line & F.col("lbproduit_cv").rlike(fv.SENIOR_PATTERN),
        classic: line & (F.col(senior) == 0),
        self_employed: F.col("rlpcodc") == fv.SELF_EMPLOYED_REF,
        private: F.col("rlpcodc") == fv.PRIVATE_REF,
        single: F.col("cdprodcdgauer") == fv.SINGLE_PRODUCT_CODE,
    }


def add_health_scopes(df: DataFrame) -> DataFrame:
    return add_flags(df, health_scope_rules(), other=fv.SCOPES[-1])


def _is_senior(formula: Column) -> Column:
    return formula.eqNullSafe(fv.SENIOR_FORMULA)


def to_senior(formula: Column, age: Column) -> Column:
    """Action 1: not on a senior formula and over 60."""
    return flag(~_is_senior(formula) & (age > 60))


def classic_upgrade(formula: Column, out_of_pocket: Column, age: Column) -> Column:
    """Action 2: not senior, over 100 out of pocket, 60 at most."""
    return flag(~_is_senior(formula) & (out_of_pocket > 100) & (age <= 60))


def senior_upgrade(formula: Column, out_of_pocket: Column) -> Column:
    """Action 3: senior and over 250 out of pocket."""
    return flag(_is_senior(formula) & (out_of_pocket > 250))


def cross_sell(multi_equipped: Column) -> Column:
    """Action 4: not multi-equipped."""
    return flag(multi_equipped == 0)


def single_family(*contracts: Column) -> Column:
    """Action 5: contracts in exactly one product family and none in the others; unknown counts are not none."""
    alone = [(c > 0) & reduce(and_, (o == 0 for o in contracts if o is not c)) for c in contracts]
    return flag(reduce(or_, (F.coalesce(a, F.lit(False)) for a in alone)))


def _has_bonus_formula(formula: Column) -> Column:
    return formula.isin(fv.SENIOR_FORMULA, fv.CLASSIC_FORMULA)


def loyalty_one_year(formula: Column, months: Column) -> Column:
    """Action 6: 6 to 29 months of seniority."""
    return flag(_has_bonus_formula(formula) & (months >= 6) & (months < 30))


def loyalty_three_years(formula: Column, months: Column) -> Column:
    """Action 7: 30 months of seniority or more."""
    return flag(_has_bonus_formula(formula) & (months >= 30))


def action_id(to_senior: Column, classic_up: Column, senior_up: Column, loyalty: Column) -> Column:
    """Four digits, one per action."""
    return F.concat(*[flag(a == 1).cast("string") for a in (to_senior, classic_up, senior_up, loyalty)])


def _digit(action: Column, position: int) -> Column:
    return F.substring(action, position, 1) == "1"


def action_label(action: Column) -> Column:
    """Label of the first action set, '' when none is."""
    return (
        F.when(_digit(action, 1), fv.LABEL_FORMULA_STEP)
        .when(_digit(action, 2) | _digit(action, 3), fv.LABEL_PRODUCT_STEP)
        .when(_digit(action, 4), fv.LABEL_LOYALTY)
        .otherwise("")
    )


def proposed_product(action: Column, product: Column, next_product: Column) -> Column:
    """Next product to offer; ``next_product`` is NULL for products off the ladder."""
    return (
        F.when(_digit(action, 3), F.coalesce(next_product, F.lit(fv.SENIOR_ENTRY)))
        .when(_digit(action, 2), F.coalesce(next_product, F.lit(fv.CLASSIC_ENTRY)))
        .when(_digit(action, 1), fv.SENIOR_ENTRY)
        .otherwise(product)
    )


def product_label(product: Column, ladder_label: Column, text: Column) -> Column:
    """Ladder label, else the free text with the code in brackets."""
    return F.coalesce(ladder_label, F.concat(text, F.lit(" ("), product, F.lit(")")))


def product_family(ladder_family: Column) -> Column:
    return F.coalesce(ladder_family, F.lit(fv.OTHER_FAMILY))


def recode(value: Column, members: Sequence[str], inside: str, outside: str) -> Column:
    """``inside`` for the listed codes, ``outside`` for all others and NULL.

    Codes that are numbers are compared as numbers too: 3, 3.0 and '3' are one code.
    """
    text = value.cast("string")
    listed = text.isin(*members)
    numbers = [float(m) for m in members if m.isdigit()]
    if numbers:
        listed = listed | F.coalesce(text.try_cast("double").isin(*numbers), F.lit(False))
    return F.when(listed, inside).otherwise(outside)


def regime(code: Column) -> Column:
    return recode(code, fv.REGIME_SPECIAL, "AM", "STEA")


def legal_frame(code: Column) -> Column:
    return recode(code, fv.LEGAL_PUBLIC, "F", "NF")


def phone(mobile: Column, landline: Column) -> Column:
    """Mobile number if any, else landline, with the leading 0; '' when both are missing."""
    def digits(number: Column) -> Column:
        return F.concat(F.lit("0"), nan_to_null(number).cast("bigint").cast("string"))

    return F.coalesce(digits(mobile), digits(landline), F.lit(""))


def atypical_simulation(known_formula: Column, actual: Column, simulated: Column) -> Column:
    """Simulation too far from the actual amount, for known formulas."""
    actual, simulated = nan_to_null(actual), nan_to_null(simulated)
    positive = F.coalesce(actual > 0, F.lit(False))
    far = (gap_percent(actual, simulated) > 10) & (gap(actual, simulated) > 5)
    return flag(known_formula & ((positive & far) | (~positive & (simulated >= 1))))


def corrected_simulation(atypical: Column, actual: Column, simulated: Column) -> Column:
    return F.when(atypical == 1, actual).otherwise(simulated)


def failed_simulation_amount(atypical: Column, actual: Column, status: Column) -> Column:
    """Actual amount when the simulation is atypical or failed, else 0."""
    return F.when((atypical == 1) | (status == "KO"), actual).otherwise(F.lit(0.0))


def score_on_ten(probability: Column, thresholds: Sequence[float]) -> Column:
    """10 above the first threshold, 9 above the second, ...; NULL below all.

    ``thresholds`` go down.
    """
    value = nan_to_null(probability)
    score = F.lit(None).cast("int")
    for rank, threshold in reversed(list(enumerate(thresholds))):
        score = F.when(value >= threshold, 10 - rank).otherwise(score)
    return score


def placeholder_score(key: Column) -> Column:
    """Stand-in score from 7 to 10, the same on every run for one key."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % 4 + 7).cast("int")
