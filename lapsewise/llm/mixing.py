"""Mixing sources to target weights by whole copies and one seeded extra copy.

The words of each source are summed, a target is set for each source, and a document is
taken floor(rate) times plus once more with probability equal to the rest of the rate, where
rate = target / words of its source. The draw hashes the document's id, so reruns agree.

Only sums travel: one row per source leaves each task, so a source that holds a third of all
rows costs no more than any other. Source tables are never brought to the driver; each round
of sharing out the excess returns four numbers.

Defined cases: a null text has no words; null sources form one source, last in order; a source
without words has target 0 and rate 0; rows with the same id draw the same number; an empty
table gives an empty result; other columns of the documents are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from lapsewise.llm.words import as_row, uniform, word_count
from lapsewise.sources.workspace import Scratch

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 8


def _weighted(sizes: DataFrame, weights: Sequence[int], scratch: Scratch) -> DataFrame:
    """``sizes`` with weights dealt in turn over the sources by code point, null last.

    Places come from a range partitioning and the row counts of the ranges before, so no
    task sees all sources.
    """
    placed = scratch.store(
        sizes.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("__place", F.monotonically_increasing_id()),
        "placed",
    )
    part, row = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    ranges = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    ranges = ranges.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    turn = F.pmod(F.col("__before") + row, F.lit(len(weights))) + 1
    dealt = F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int"))
    return placed.withColumn("__part", part).join(ranges, "__part").select("source", "source_size", dealt.alias("weight"))


def source_targets(
    sizes: DataFrame, scratch: Scratch, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``source, source_size, target, rate`` from ``source, source_size``.

    The sources share ``share`` times all words by weight. What lies above ``most`` times a
    source's words is shared again by the others, until none is above.
    """
    table = scratch.store(_weighted(sizes, weights, scratch), "weighted")
    cap, level, capped = F.col("source_size") * most, None, -1
    while True:
        above = F.lit(False) if level is None else cap < F.lit(level) * F.col("weight")
        total, held, rest, n = table.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.count(F.when(above, 1)),
        ).first()
        if n == capped or not rest:
            break
        level, capped = (total * share - held) / rest, n
    target = F.least(cap.cast("double"), F.lit(float(level or 0)) * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return scratch.store(table.select("source", "source_size", target.alias("target"), rate.alias("rate")), "targets")


def with_copies(
    sized: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", seed: int = SEED
) -> DataFrame:
    """``sized`` with its source's ``source_size`` and ``target``, and ``copies``: how often a row is taken."""
    rates = targets.withColumnRenamed("source", "__source")
    copies = F.floor("rate") + F.when(uniform(F.col(key), seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    joined = sized.join(rates, F.col(source).eqNullSafe(F.col("__source")))
    return joined.withColumn("copies", copies.cast("bigint")).drop("__source", "rate")


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The documents, each repeated as often as the mix takes it, in the columns they came with."""
    scratch = Scratch(docs.sparkSession, "mixing")
    row = as_row(docs)  # so that no name can clash
    sized = row.select(
        "__row", F.col(f"__row.{key}").alias("doc_id"), F.col(f"__row.{source}").alias("source"),
        word_count(F.col(f"__row.{text}")).alias("size"),
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    taken = with_copies(sized, source_targets(sizes, scratch), seed=seed)
    return taken.where("copies > 0").select("__row", F.explode(F.sequence(F.lit(1), "copies"))).select("__row.*")


def mixture_report(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row, those not taken included."""
    scratch = Scratch(docs.sparkSession, "mixture")
    sized = scratch.store(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sized")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    marked = with_copies(sized, source_targets(sizes, scratch), seed=seed)
    return marked.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
