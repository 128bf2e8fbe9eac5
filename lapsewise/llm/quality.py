"""Text quality by a sparse rule ensemble.

A forest of shallow trees is fitted on statistics of labelled texts. Every path from a root to
a node becomes a rule, a conjunction of bounds on statistics. A logistic regression with a lasso
penalty weighs the rules, and the few with a weight are compiled into one column expression, so
scoring is a projection: no shuffle, no Python, whole texts.

The classifier is fitted on at most about ``SAMPLE_ROWS`` labelled rows, drawn by a hash of the
identifier (the bound is on the expected number); their identifiers are broadcast, 16 bytes each.

Defined cases: null texts score like empty ones, by the rules that hold for statistics of 0; rows
without a label, or with a null one, are not learned from; of labels repeated for a document the
largest counts; if no label or a single class is left to learn from, the score is that class (1 if
none); an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from lapsewise.llm.words import GAP, as_row, uniform, word_count
from lapsewise.sources.workspace import Scratch

SAMPLE_ROWS = 20_000
TREES, DEPTH = 16, 3
LASSO = 0.002
THRESHOLD = 0.3
HELD_OUT = (5, 0)
SEED = 5


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text, each 0 where there is nothing to divide by."""
    whole = F.coalesce(text, F.lit(""))
    chars, words = F.length(whole).cast("double"), word_count(whole).cast("double")
    kinds = F.size(F.array_distinct(F.split(F.lower(whole), GAP))).cast("double")

    def share(part: Column, of: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), of), F.lit(0.0))

    def count(pattern: str) -> Column:
        return F.regexp_count(whole, F.lit(pattern))

    return {
        "words": words,
        "word_length": share(chars, words),
        "distinct_words": share(kinds, words),
        "upper": share(count(r"\p{Lu}"), chars),
        "digits": share(count("[0-9]"), chars),
        "stops": share(count(r"[.,;:]"), words),
        "loud": share(count(r"[!?]"), words),
        "symbols": share(count(r"[#$%&*+=<>@^~_\\{}\[\]]"), words),
        "bars": share(count(r"[|/]"), words),
        "lines": share(count(r"\n"), words),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of bounds ``(statistic, is upper bound, value)``."""

    bounds: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        return reduce(and_, (F.col(n) <= v if upper else F.col(n) > v for n, upper, v in self.bounds))


def paths(debug: str, names: Sequence[str]) -> list[Rule]:
    """Rules of a fitted forest: every path from a root downwards, in the order of its printed trees."""
    found: dict[Rule, None] = {}
    open_bounds: list[tuple[int, tuple[str, bool, float]]] = []
    for line in debug.splitlines():
        step = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)", line)
        if not step:
            continue
        depth = len(step[1])
        open_bounds = [b for b in open_bounds if b[0] < depth]
        open_bounds.append((depth, (names[int(step[2])], step[3] == "<=", float(step[4]))))
        tightest = {(n, upper): v for _, (n, upper, v) in open_bounds}  # a later bound is the tighter one
        found[Rule(tuple(sorted((n, upper, v) for (n, upper), v in tightest.items())))] = None
    return list(found)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules. ``score`` reads the columns :func:`statistics` names."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(labelled: DataFrame, lasso: float = LASSO, trees: int = TREES, depth: int = DEPTH) -> RuleEnsemble:
    """Fit on ``label`` (0 or 1) and the statistics columns; the frame is read several times, so store it."""
    classes = [r.label for r in labelled.select("label").distinct().collect()]
    if len(classes) < 2:
        return RuleEnsemble(-50.0 if classes == [0.0] else 50.0, ())
    names = [c for c in labelled.columns if c != "label"]
    vectors = VectorAssembler(inputCols=names, outputCol="statistics").transform(labelled)
    forest = RandomForestClassifier(
        featuresCol="statistics", labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="onethird"
    ).fit(vectors)
    rules = paths(forest.toDebugString, names)
    marks = labelled.select("label", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    marks = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="rules").transform(marks)
    weighed = LogisticRegression(featuresCol="rules", labelCol="label", regParam=lasso, elasticNetParam=1.0, maxIter=60).fit(marks)
    weights = zip(rules, weighed.coefficients.toArray().tolist(), strict=True)
    return RuleEnsemble(weighed.intercept, tuple((r, w) for r, w in weights if w))


def held_out(key: Column, modulus: int = HELD_OUT[0], remainder: int = HELD_OUT[1]) -> Column:
    """Whether a document is kept from learning; a null identifier counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % modulus == remainder


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleEnsemble:
    """Fit on a hash sample of the labelled documents that are not held out. ``docs`` has ``doc_id, text``."""
    scratch = Scratch(docs.sparkSession, "quality")
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    share = min(1.0, sample_rows / max(1, known.count()))
    known = known.where(uniform(F.col("doc_id"), SEED) < share)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return fit(scratch.store(rows.select("label", *[c.alias(n) for n, c in statistics(F.col("text")).items()]), "sample"))


def scored(docs: DataFrame, model: RuleEnsemble, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` as a column ``__row``, with ``score``, ``predicted`` and ``task``.

    A condition on the score would be pushed below the statistics and there count each of them anew
    for every rule. One that names ``task`` as well stays above, as a task's number is known there only.
    """
    row, stats = as_row(docs), statistics(F.col(f"__row.{text}"))
    counted = row.select("__row", F.spark_partition_id().alias("task"), *[c.alias(n) for n, c in stats.items()])
    judged = counted.select("__row", "task", model.score().alias("score"))
    return judged.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    narrow = docs.select("doc_id", "text")
    judged = scored(narrow, learn(narrow, labels))
    key = F.col("__row.doc_id")
    return judged.select(key.alias("doc_id"), held_out(key).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents the classifier does not reject, in the columns they came with."""
    return scored(docs, learn(docs, labels)).where("predicted = 1 AND task >= 0").select("__row.*")
