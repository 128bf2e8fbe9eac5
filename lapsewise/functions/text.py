"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def zero_fill(value: Column, width: int) -> Column:
    """Pad with zeros on the left; longer text is kept whole (``lpad`` would cut it)."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def upper_or_empty(value: Column) -> Column:
    return F.upper(F.coalesce(value, F.lit("")))


def rejoin(value: Column, sep: str = " / ", trim: bool = False) -> Column:
    """Comma list with another separator, keeping blanks unless ``trim``."""
    parts = F.split(value, ",")
    if trim:
        parts = F.transform(parts, lambda part: F.trim(part))
    return F.array_join(parts, sep)


def measure_kind(name: Column) -> Column:
    """First token of a measure name, e.g. ``nbCtr`` of ``nbCtr_top_part``."""
    return F.split(name, "_")[0]


def measure_product(name: Column) -> Column:
    """Tokens from the third on, e.g. ``santeis_clas`` of ``nbCtr_top_santeis_clas``."""
    tokens = F.split(name, "_")
    return F.array_join(F.slice(tokens, 3, F.greatest(F.size(tokens) - 2, F.lit(0))), "_")


def compact_thousands(value: Column) -> Column:
    """12 400 -> ``12k``; thousands rounded half to even."""
    return F.concat(F.bround(value / F.lit(1000), 0).cast("bigint").cast("string"), F.lit("k"))


def stock_label(year: Column, stock: Column) -> Column:
    return F.concat(
        year.cast("string"), F.lit(" (stock = "), stock.cast("bigint").cast("string"), F.lit(")")
    )


def text_list(value: Column) -> Column:
    """JSON text such as ``["a", "b"]`` as an array of strings."""
    return F.from_json(value, "array<string>")


def policy_number(contract: Column, company: Column, companies, width: int) -> Column:
    """Contract number, left-padded to ``width`` for the listed companies."""
    return F.when(company.isin(*companies), F.lpad(contract, width, "0")).otherwise(contract)


def contract_key(*parts: Column) -> Column:
    """Parts joined by ``_``; NULL as soon as one part is NULL."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit("_"), part.cast("string")]
    return F.concat(*pieces)
