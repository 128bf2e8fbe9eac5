"""Sales messages as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from lapsewise import fixed_values as fv
from lapsewise.functions.text import rejoin


def _choice(key: Column, options: Mapping[str, str], default: Column | str) -> Column:
    branch = F.lit(default) if isinstance(default, str) else default
    for value, text in options.items():
        branch = F.when(key == value, text).otherwise(branch)
    return branch


def finding(other_products: Column, reasons: Column, trim: bool = False) -> Column:
    """Products held next to the home contract, then the reasons of fragility."""
    held = F.when(F.coalesce(other_products, F.lit("")) == "", fv.ONLY_HOME).otherwise(
        F.concat(F.lit(fv.ALSO_HOLDS), rejoin(other_products, trim=trim))
    )
    plain = F.replace(F.translate(reasons, "[]\"'", ""), F.lit(fv.CLIENT_WORDS), F.lit(fv.CLIENT_PRONOUN))
    why = F.when(F.coalesce(reasons, F.lit(fv.NO_REASONS)) == fv.NO_REASONS, fv.AVERAGE_RISK).otherwise(
        F.concat(F.lit(fv.FRAGILE_BECAUSE), rejoin(plain, trim=trim))
    )
    return F.concat(held, F.lit(". "), why, F.lit("."))


def offer(
    proposal: Column,
    family_status: Column,
    family_size: Column,
    advisor: Column,
    health_formula: Column,
    health_price: Column,
    funeral_formula: Column,
    funeral_price: Column,
    trim: bool = False,
) -> Column:
    """What to offer, with cover and price per product line, or that no advisor is there.

    Formulas outside the fixed list appear by their code; a family size without a
    price leaves the price out.
    """
    proposal = F.coalesce(proposal, F.lit(""))
    appetite = F.when(proposal == "", fv.NO_APPETITE).otherwise(
        F.concat(F.lit(fv.HAS_APPETITE), rejoin(proposal, trim=trim))
    )

    def has(line: str) -> Column:
        return proposal.contains(line)

    low = _choice(family_size, {k: v[0] for k, v in fv.ACCIDENT_PRICES.items()}, F.lit(None).cast("string"))
    high = _choice(family_size, {k: v[1] for k, v in fv.ACCIDENT_PRICES.items()}, F.lit(None).cast("string"))
    accident_price = F.concat(
        F.lit(fv.PRICE_IS), low, F.lit(fv.ACCIDENT_LOW + " / "), high, F.lit(fv.ACCIDENT_HIGH)
    )
    accident = F.concat(
        F.lit(fv.ACCIDENT_OFFER), F.coalesce(family_size, F.lit("")), F.lit(fv.ACCIDENT_FAMILY),
        F.coalesce(family_status, F.lit("")), F.lit(", "), F.coalesce(accident_price, F.lit("")),
    )
    health = F.concat(
        F.lit(fv.HEALTH_OFFER), _choice(health_formula, fv.HEALTH_FORMULAS, F.coalesce(health_formula, F.lit(""))),
        F.lit("), " + fv.PRICE_IS), F.coalesce(health_price.cast("string"), F.lit("")), F.lit(fv.CURRENCY_END),
    )
    funeral = F.concat(
        F.lit(fv.FUNERAL_OFFER), _choice(funeral_formula, fv.FUNERAL_FORMULAS, funeral_formula),
        F.lit("), " + fv.PRICE_IS_ABOUT), F.coalesce(funeral_price.cast("string"), F.lit("")),
        F.lit(fv.CURRENCY_END),
    )
    priced_funeral = has(fv.FUNERAL_LINE) & (F.coalesce(funeral_formula, F.lit("")) != "")
    advice = F.when(advisor == "N", fv.NO_ADVISOR).otherwise(
        F.concat(
            F.when(has(fv.ACCIDENT_LINE), accident).otherwise(""),
            F.when(has(fv.HEALTH_LINE), health).otherwise(""),
            F.when(priced_funeral, funeral).otherwise(""),
        )
    )
    return F.concat(appetite, F.lit(". "), advice)
