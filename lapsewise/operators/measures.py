"""Distinct clients and contracts: in stock, and terminated.

Distinct counts are taken in two combining steps, first per id and then per group.
Nothing is expanded once per flag and no group's ids meet in one task.

The active months of an id are bits of a number, ``bit_or`` merges its rows, and equal
bit patterns are counted before any month is spelled out. ``stock`` and ``terminations``
take the bits from contract-months or lists of months; ``stock_of_spans`` and ``terminations_of_spans``
give the same results from the spans themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from lapsewise.functions.dates import month_key, month_key_of_number, month_number_of
from lapsewise.operators.columns import DEFAULT, Names
from lapsewise.operators.spans import active_between, drop_empty, merge_ends, within_months
from lapsewise.sources.workspace import stored

CLIENTS = "nbCli"
CONTRACTS = "nbCtr"
KINDS = (CLIENTS, CONTRACTS)
WORD = 60  # months per bit pattern


def _ids(names: Names) -> str:
    """Both ids of a row as rows of (kind, id)."""
    return (
        f"inline(array(struct('{CLIENTS}' as kind, cast(`{names.client}` as string) as id), "
        f"struct('{CONTRACTS}' as kind, cast(`{names.contract}` as string) as id)))"
    )


def _marks(flags: Sequence[str] | None) -> dict[str, str]:
    """Condition of each flag under its short name; one that always holds without flags."""
    return {f"m{i}": f"`{f}` = 1" for i, f in enumerate(flags)} if flags else {"m0": "true"}


def _measures(flags: Sequence[str] | None) -> dict[tuple[str, str], str]:
    """Output name by mark and kind of id."""
    names = [f"_{f}" for f in flags] if flags else [""]
    return {(f"m{i}", kind): f"{kind}{name}" for i, name in enumerate(names) for kind in KINDS}


def _count(kind: str, value: str) -> str:
    """Ids of a kind, from rows of one id each."""
    return f"sum(if(kind = '{kind}' and id is not null, {value}, 0))"


def _expressions(*texts: str) -> list:
    return [F.expr(t) for t in texts]


def _in_bits(monthly: DataFrame, period: str, leaving: bool) -> DataFrame:
    """Add the periods of a row as ``__bits`` of the word ``__word``, and those of them in which it leaves as ``__left``."""
    if "months" in monthly.columns:
        if period != "month":
            raise ValueError("lists of months are counted by month")
        rows = monthly.selectExpr("*", f"explode(sequence(months[0] div {WORD}, element_at(months, -1) div {WORD})) as __word")
        bit = f"shiftleft(1L, cast(m % {WORD} as int))"
        rows = rows.selectExpr("*", f"aggregate(months, 0L, (b, m) -> if(m div {WORD} = __word, b | {bit}, b)) as __bits")
        if leaving:
            rows = rows.selectExpr("*", f"{_number('exit_month', period)} as m").selectExpr("*", f"if(m div {WORD} = __word, __bits & {bit}, 0L) as __left")
        return rows
    rows = monthly.selectExpr("*", f"{_number(period, period)} as __number")
    # a missing period is one of its own
    rows = rows.selectExpr("*", f"__number div {WORD} as __word", f"coalesce(shiftleft(1L, cast(__number % {WORD} as int)), 1L) as __bits")
    return rows.selectExpr("*", f"if({period} = exit_{period}, __bits, 0L) as __left") if leaving else rows


def _number(text: str, period: str) -> str:
    year = f"cast(substr({text}, 1, 4) as int)"
    return f"({year} * 12 + cast(substr({text}, 5, 2) as int) - 1)" if period == "month" else year


def _by_period(rows: DataFrame, period: str, by: Sequence[str], marks: dict[str, str], names: Names) -> DataFrame:
    """Of each period and group the ``kind`` and number ``ids`` of the ids with equal ``marks`` (0 or 1), given as bits.

    The periods of an id travel as bits, so that one row per id and group is shuffled, not one per month.
    """
    marks = {"here": "__bits", **marks}
    rows = rows.selectExpr(*by, "__word", *[f"{bits} as {m}" for m, bits in marks.items()], _ids(names))
    keys = [*by, "__word", "kind"]
    per_id = rows.groupBy(*keys, "id").agg(*_expressions(*[f"bit_or({m}) as {m}" for m in marks]))
    alike = per_id.groupBy(*keys, *marks).agg(F.count("id").alias("ids"))
    spelled = alike.selectExpr("*", f"explode(sequence(0, {WORD - 1})) as __at").where("shiftright(here, __at) & 1 = 1")
    at = F.expr(f"__word * {WORD} + __at")
    text = month_key_of_number(at) if period == "month" else F.lpad(at.cast("string"), 4, "0")
    bits = [f"cast(shiftright({m}, __at) & 1 as int) as {m}" for m in marks if m != "here"]
    return spelled.select(text.alias(period), *by, "kind", "ids", *_expressions(*bits))


def _counted(kind: str, mark: str) -> str:
    """Ids of a kind with a mark, from rows of ids with equal marks."""
    return f"sum(if(kind = '{kind}', ids * {mark}, 0))"


def stock(monthly: DataFrame, flags: Sequence[str] | None = None, names: Names = DEFAULT) -> DataFrame:
    """Distinct clients and contracts per month, or per month, network and flag.

    ``monthly`` has contract-months, or spans with the list of their ``months`` (:func:`spans.list_months`).
    A flag without any row in a month and network gives NULL.
    """
    by = [names.network] if flags else []
    marks = {m: f"if({c}, __bits, 0L)" for m, c in _marks(flags).items()}
    alike = _by_period(_in_bits(monthly, "month", leaving=False), "month", by, marks, names)
    counts = [f"if(max({m}) = 1, {_counted(kind, m)}, null) as `{out}`" for (m, kind), out in _measures(flags).items()]
    return alike.groupBy("month", *by).agg(*_expressions(*counts)).orderBy("month", *by)


def terminations(
    monthly: DataFrame,
    period: str = "month",
    flags: Sequence[str] | None = None,
    sentinel: bool = False,
    names: Names = DEFAULT,
) -> DataFrame:
    """Distinct clients and contracts whose exit falls in the row's month or year.

    NULL where the flag has no row, 0 where it has rows and no exit. ``sentinel`` adds
    one to the contract count of groups with a contract that stays, as a count does
    that keeps a placeholder id for such contracts. By month, ``monthly`` may have lists as in :func:`stock`.
    """
    by = [names.network] if flags else []
    marks = {}
    for mark, condition in _marks(flags).items():
        marks |= {mark: f"if({condition}, __bits, 0L)", f"leaves_{mark}": f"if({condition}, __left, 0L)"}
        if sentinel:
            marks[f"stays_{mark}"] = f"if({condition}, __bits & ~__left, 0L)"
    alike = _by_period(_in_bits(monthly, period, leaving=True), period, by, marks, names)
    counts = []
    for (mark, kind), out in _measures(flags).items():
        count = _counted(kind, f"leaves_{mark}")
        if sentinel and kind == CONTRACTS:
            count = f"{count} + max(stays_{mark})"
        counts.append(f"if(max({mark}) = 1, {count}, null) as `{out}`")
    return alike.groupBy(period, *by).agg(*_expressions(*counts)).orderBy(period, *by)


def narrow_spans(df: DataFrame, first: str, last: str, flags: Sequence[str], names: Names = DEFAULT) -> DataFrame:
    """The rows and columns that all counts between two months need."""
    spans = drop_empty(active_between(df, first, last, names), names)
    return spans.select(*dict.fromkeys([names.contract, names.client, names.start, names.end, names.network, *flags]))


def _bits(word: int) -> str:
    """Active months of a span within one word, as bits."""
    low = f"greatest(lo, {word * WORD}) - {word * WORD}"
    high = f"least(hi, {word * WORD + WORD - 1}) - {word * WORD}"
    return f"if({low} <= {high}, shiftleft(1L, {high} + 1) - shiftleft(1L, {low}), 0L)"


def stock_of_spans(
    df: DataFrame, first: str, last: str, flags: Sequence[str] | None = None, names: Names = DEFAULT
) -> DataFrame:
    """:func:`stock` of the portfolio between two months, straight from its spans.

    One shuffle of one row per id and network, whatever the number of months or flags.
    """
    spans = drop_empty(within_months(df, first, last, names), names)
    months = month_number_of(last) - month_number_of(first) + 1
    words = range(-(-months // WORD))
    by = [names.network] if flags else []
    marks = {"all": "true", **(_marks(flags) if flags else {})}
    patterns = {f"{m}_{w}": f"if({c}, bits_{w}, 0L)" for m, c in marks.items() for w in words}
    rows = spans.selectExpr("*", *[f"{_bits(w)} as bits_{w}" for w in words]).selectExpr(
        *by, *[f"{bits} as {p}" for p, bits in patterns.items()], _ids(names)
    )
    per_id = rows.groupBy(*by, "kind", "id").agg(*_expressions(*[f"bit_or({p}) as {p}" for p in patterns]))
    alike = per_id.groupBy(*by, "kind", *patterns).agg(F.count("id").alias("ids"))

    def bit(mark: str) -> str:
        if len(words) == 1:
            return f"shiftright({mark}_0, at) & 1"
        word = f"element_at(array({', '.join(f'{mark}_{w}' for w in words)}), cast(at div {WORD} as int) + 1)"
        return f"shiftright({word}, at % {WORD}) & 1"

    counted = list(_marks(flags)) if flags else ["all"]
    monthly = (
        alike.selectExpr("*", f"explode(sequence(0, {months - 1})) as at")
        .where(f"{bit('all')} = 1")
        .selectExpr(*by, "at", "kind", "ids", *[f"{bit(m)} as {m}" for m in counted])
    )
    counts = [
        f"if(max({m if flags else 'all'}) = 1, sum(if(kind = '{kind}', ids * {m if flags else 'all'}, 0)), null) as `{out}`"
        for (m, kind), out in _measures(flags).items()
    ]
    month = month_key_of_number(F.col("at") + month_number_of(first)).alias("month")
    totals = monthly.groupBy("at", *by).agg(*_expressions(*counts))
    return totals.select(month, *[c for c in totals.columns if c != "at"]).orderBy("month", *by)


PERIODS = ("month", "year")


def _period(period: str, day: Column) -> Column:
    return month_key(day) if period == "month" else F.year(day).cast("string")


def exits_by_period(
    df: DataFrame,
    first: str,
    last: str,
    periods: Sequence[str] = PERIODS,
    flags: Sequence[str] | None = None,
    names: Names = DEFAULT,
) -> DataFrame:
    """Distinct clients and contracts leaving per ``period``: months (yyyyMM) and years (yyyy) in one pass.

    A version is active in the exit period of its contract just when its own end lies
    in that period. So only versions ending by the last period are looked at, each
    counts once in a month and once in a year at most, and no month is spelled out.
    """
    marks, by = _marks(flags), [names.network] if flags else []
    until = {"month": last, "year": last[:4]}
    spans = drop_empty(within_months(df, first, last, names), names)
    keep_marked = _expressions(*[f"max({m}) as {m}" for m in marks])
    end = F.col(names.end)
    ends_by = [_period(p, end) <= F.lit(until[p]) for p in periods]
    leaving = (
        spans.select(
            *by, names.contract, names.client, names.end, end.alias("__own"),
            *_expressions(*[f"if({c}, 1, 0) as {m}" for m, c in marks.items()]),
        )
        .where(reduce(or_, ends_by))
        .groupBy(*by, names.contract, names.client, names.end, "__own")
        .agg(*keep_marked)
    )
    leavers = merge_ends(leaving, names, spans.select(names.contract, names.end))
    own = F.col("__own")
    left = [
        F.when((_period(p, own) == _period(p, end)) & (_period(p, own) <= F.lit(until[p])), _period(p, own)) for p in periods
    ]
    keys = ["period", *by]
    per_id = (
        leavers.withColumn("period", F.explode(F.array_compact(F.array(*left))))
        .selectExpr(*keys, *marks, _ids(names))
        .groupBy(*keys, "kind", "id")
        .agg(*keep_marked)
    )
    counts = [f"{_count(kind, m)} as `{out}`" for (m, kind), out in _measures(flags).items()]
    return per_id.groupBy(*keys).agg(*_expressions(*counts))


def exits_of_spans(
    df: DataFrame,
    first: str,
    last: str,
    period: str = "month",
    flags: Sequence[str] | None = None,
    names: Names = DEFAULT,
) -> DataFrame:
    """Distinct clients and contracts leaving per period; only periods with an exit appear."""
    return exits_by_period(df, first, last, (period,), flags, names).withColumnRenamed("period", period)


def terminations_of_spans(
    df: DataFrame,
    first: str,
    last: str,
    period: str = "month",
    flags: Sequence[str] | None = None,
    names: Names = DEFAULT,
    stock: DataFrame | None = None,
    exits: DataFrame | None = None,
    store: bool = True,
) -> DataFrame:
    """:func:`terminations` between two months, straight from the spans.

    ``stock`` is the stock of the same spans, if at hand; it tells which flags have rows. So are ``exits`` their
    :func:`exits_by_period`. Without both the spans are read three times, so ``store`` writes their narrow columns
    once instead of running what is behind them again.
    """
    by = [period, names.network] if flags else [period]
    measures = _measures(flags).values()
    if store and (stock is None or exits is None):
        df = stored(narrow_spans(df, first, last, flags or (), names), "spans")
    if exits is None:
        exits = exits_of_spans(df, first, last, period, flags, names)
    else:
        size = 6 if period == "month" else 4
        exits = exits.where(F.length("period") == size).withColumnRenamed("period", period)
    present = stock_of_spans(df, first, last, flags, names) if stock is None else stock
    if period == "year":
        present = (
            present.withColumn("year", F.substring("month", 1, 4))
            .groupBy(*by)
            .agg(*_expressions(*[f"max(`{m}`) as `{m}`" for m in measures]))
        )
    joined = present.join(exits.withColumnsRenamed({m: f"__{m}" for m in measures}), by, "left")
    return joined.selectExpr(
        *[f"`{b}`" for b in by], *[f"if(`{m}` is not null, coalesce(`__{m}`, 0L), null) as `{m}`" for m in measures]
    ).orderBy(*by)
