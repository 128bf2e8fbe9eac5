"""Drawing campaign lists: top rows, ties, control groups, waves and quotas.

Every draw has an explicit order that ends with the id, so that a rerun draws the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from lapsewise import fixed_values as fv
from lapsewise.operators import joins, quality
from lapsewise.sources.workspace import stored

Order = Sequence[tuple[str, str]]  # (column, 'asc' or 'desc'), the first one counts most


def sorting(order: Order) -> list[Column]:
    return [F.col(c).asc() if way == "asc" else F.col(c).desc() for c, way in order]


def draw_key(key: Column, seed: int | str = 1) -> Column:
    """Pseudo-random order of ids that depends on the seed and the id only."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _within(frame: DataFrame, k: int, order: Order, keys: Sequence[str]) -> DataFrame:
    """Positions with fewer than ``k`` rows (``__rows``) before them among those with the same keys."""
    before = Window.partitionBy(*keys).orderBy(*sorting(order)).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("__rows").over(before), F.lit(0))
    return frame.withColumn("__ahead", ahead).where(F.col("__ahead") < k).drop("__ahead")


def _sliced(df: DataFrame, k: int, order: Order, by: Sequence[str], slices: int | None) -> DataFrame:
    """Distinct values of the order columns with their ``__rows``, without those that ``k`` rows of their own slice precede.

    Slices are dealt by hash, as many as there are shuffle partitions unless given.
    """
    columns = [c for c, _ in order]
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(*by, *columns).agg(F.count(F.lit(1)).alias("__rows"))
    counted = counted.withColumn("__slice", F.pmod(F.xxhash64(*columns), F.lit(slices)))
    return _within(counted, k, order, [*by, "__slice"])


def _ranged(df: DataFrame, k: int, order: Order) -> DataFrame:
    """Distinct values of the order columns with fewer than ``k`` rows before them, with ``__rows`` and ``__ahead``.

    Positions are dealt by ranges of the order and written once; a sum for each range, as many as there are
    partitions, tells how many rows precede it. Only ranges that begin before the k-th row are looked at
    again, each by itself: no task meets more than one range, whatever ``k`` and the number of partitions.
    """
    columns = [c for c, _ in order]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__rows"))
    dealt = counted.repartitionByRange(*sorting(order)).withColumn("__range", F.spark_partition_id())
    dealt = stored(dealt, "positions")
    sums = dealt.groupBy("__range").agg(F.sum("__rows").alias("__sum"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    offsets = sums.select("__range", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    near = dealt.join(offsets.where(F.col("__offset") < k), "__range")
    before = Window.partitionBy("__range").orderBy(*sorting(order)).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("__offset") + F.coalesce(F.sum("__rows").over(before), F.lit(0))
    return near.withColumn("__ahead", ahead).where(F.col("__ahead") < k).select(*columns, "__rows", "__ahead")


def _positions(df: DataFrame, k: int, order: Order, by: Sequence[str], slices: int | None) -> DataFrame:
    """Distinct values of the order columns with fewer than ``k`` rows before them in the group.

    Equal positions are counted before they are ordered, groups in slices first. What is
    left of a group for the final ordering is at most ``slices * k`` positions.
    """
    if not by:
        return _ranged(df, k, order).select(*[c for c, _ in order])
    return _within(_sliced(df, k, order, by, slices), k, order, by).select(*by, *[c for c, _ in order])


def top_n(df: DataFrame, n: int, order: Order) -> DataFrame:
    """The first ``n`` rows in ``order``, whose last column should be an id.

    The order columns alone are ranked, range by range, and the rows fetched by the positions taken, in the same way
    for any ``n``. Of rows that share the last position taken (an id repeated) only as many stay as are missing.
    """
    columns = [c for c, _ in order]
    taken = _ranged(df, n, order)
    match = [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in columns]
    rows = df.alias("d").join(taken.alias("t"), reduce(and_, match)).select("d.*", "t.__rows", "t.__ahead")
    copy = F.row_number().over(Window.partitionBy(*columns).orderBy("__ahead"))
    kept = rows.withColumn("__copy", copy).where(F.col("__ahead") + F.col("__copy") <= n)
    return kept.drop("__rows", "__ahead", "__copy").orderBy(*sorting(order))


def control_group(df: DataFrame, key: str, n: int, seed: int = 1, out: str = "temoin") -> DataFrame:
    """Flag ``n`` ids drawn by seeded hash, all of them when there are fewer."""
    ids = df.select(F.col(key).alias("__drawn")).distinct()
    ids = ids.withColumn("__order", draw_key(F.col("__drawn"), seed))
    drawn = top_n(ids, n, [("__order", "asc"), ("__drawn", "asc")]).select("__drawn")
    marked = df.join(drawn, F.col(key) == F.col("__drawn"), "left")
    return marked.withColumn(out, F.col("__drawn").isNotNull()).drop("__drawn")


def top_with_ties(
    df: DataFrame, k: int, order: Order, by: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """Rows among the first ``k`` of their group, with all rows tied with the last one.

    Rows with a NULL in an order column are left out.
    """
    by, columns = list(by), [c for c, _ in order]
    known = df.dropna(subset=columns)
    taken = _positions(known, k, order, by, slices)
    kept = known.join(taken, [*by, *columns], "left_semi")
    return kept.select(*df.columns)


def wave(
    candidates: DataFrame,
    order: Order,
    key: str = "identifiant",
    contacts: int = fv.CONTACTS_PER_WAVE,
    controls: int = fv.CONTROLS_PER_WAVE,
    seed: int = 1,
) -> DataFrame:
    """One campaign wave: eligible rows, the first of them in order, and its control group."""
    eligible = quality.apply_steps(candidates, wave_steps())
    # written once, as the control group is drawn from it
    drawn = stored(top_n(eligible, contacts + controls, [*order, (key, "asc")]), "drawn")
    return control_group(drawn, key, controls, seed)


def wave_steps() -> dict[str, Column]:
    """Filter steps of a wave, for :func:`quality.funnel` as well."""
    return {
        "not contacted": F.col("Contact") == "-",
        "advisor present": F.col("Presence_CC") == "O",
        "target proposal": F.col("proposition").isin(*fv.TARGET_PROPOSALS),
        "age limit": F.col("age_assure") <= fv.MAX_AGE,
    }


def draw_or_reuse(
    candidates: DataFrame,
    former: DataFrame | None,
    order: Order,
    key: str = "identifiant",
    former_key: str = "id_contrat",
    **options,
) -> DataFrame:
    """The stored list with its control flags when there is one, else a new wave."""
    if former is None:
        return wave(candidates, order, key, **options)
    kept = joins.keep_members(candidates, key, former, former_key)
    return joins.mark_members(kept, key, former.where(F.col("temoin")), former_key, "temoin")


def anniversary_month(month: Column) -> Column:
    """Month of the contracts a wave of ``month`` looks at: five months on, 1 to 12."""
    return F.pmod(month + 4, F.lit(12)) + 1


def dormant_steps() -> dict[str, Column]:
    """Eligibility for the quota draw."""
    leaving = F.col("nb_mois_depuis_resiliation")
    return {
        "fragile": F.col("score_fragilite") >= 7,
        "seniority": F.col("anciennete_contrat_mois") > 6,
        "not leaving": leaving.isNull() | F.isnan(leaving.cast("double")) | (leaving < -1),
        "action": ((F.col("actions_123") > 0) & (F.col("Presence_CC") == "O")) | (F.col("actions_67") > 0),
    }


def quota_waterfall(
    candidates: DataFrame,
    quota: int,
    extraction_month: Column,
    key: str = "identifiant",
    score: str = "score_model",
    ties: bool = False,
) -> DataFrame:
    """Highest scores among anniversaries five months on, then January's, up to the quota.

    ``ties`` also takes rows tied with the last score drawn.
    """
    month = F.col("mois_anniversaire")
    bucket = F.when(month == anniversary_month(extraction_month), 1).when(month == 1, 2)
    rows = (
        quality.apply_steps(candidates, dormant_steps())
        .withColumn("bucket", bucket)
        .where(F.col("bucket").isNotNull())
    )
    if ties:
        return top_with_ties(rows, quota, [("bucket", "asc"), (score, "desc")])
    return top_n(rows, quota, [("bucket", "asc"), (score, "desc"), (key, "asc")])
