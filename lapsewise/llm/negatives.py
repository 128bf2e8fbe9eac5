"""Hard negatives by best-first search in STR-packed R-trees.

A vector's components become the integers floor(``SCALE`` * x); the score of two rows is their inner product. An
anchor's positives are its best other rows of the same label; for each of them the best rows of other labels are
wanted whose score is between ``low`` and ``high`` percent of the positive's.

1. Packing. Rows are dealt by ranges of label, first component and identifier, and cut into blocks of one label and about
   ``BLOCK`` bytes. Each block is tiled (sort-tile-recursive): sorted by one component, cut into slabs, each slab
   sorted by the next component, down to leaves of ``LEAF`` rows. Leaves and inner nodes, ``FANOUT`` at a time, have
   minimum bounding boxes.
2. Search. The anchors go to all stripes of up to ``HELD`` blocks: a stated set of queries against all rows. A box gives
   an interval of scores, the sum of the intervals of its components. One queue for an anchor takes boxes from the
   highest upper end down; a box is left out for a window of scores that its interval misses, or if its upper end
   is strictly below the worst of the rows already found where these are as many as wanted.
3. The best of all stripes are ranked by score, then identifier.

The search is exact. Scores are computed in double precision where all sums stay below 2^53, else with whole numbers of
any size; scores beyond a bigint are given and compared as its ends.

Defined cases: rows with a null identifier, label or vector, or a component that is null, not finite, or not finite times
``SCALE``, take no part; shorter vectors go on with zeros; of rows with equal identifiers the one with the smallest
label, then vector, takes part; ties go to the smaller identifier; an anchor without positives, or a positive
without negatives, gives no row; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import heapq
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from lapsewise.sources.workspace import Scratch

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LEAF, FANOUT = 16, 8
BLOCK = 1 << 20  # bytes of the vectors of a block
HELD = 32  # blocks in a stripe
ASKS = 64  # anchors whose intervals are computed at once
LONGS = (-(2**63), 2**63 - 1)
BLOCKS = "block bigint, label string, ids binary, vectors binary"
FOUND = "anchor_id bigint, positive_id bigint, id bigint, positive_score bigint, score bigint"
_FOUND = pa.schema([(c.split()[0], pa.int64()) for c in FOUND.split(", ")])


def tiled(vectors: np.ndarray) -> np.ndarray:
    """The order of the rows in which every ``LEAF`` of them are a tile."""

    def tile(rows: np.ndarray, at: int) -> list[np.ndarray]:
        pages = -(-len(rows) // LEAF)
        if pages <= 1 or at == len(spread):
            return [rows]
        slabs = int(np.ceil(round(pages ** (1 / (len(spread) - at)), 9)))
        rows = rows[np.argsort(vectors[rows, spread[at]], kind="stable")]
        size = -(-pages // slabs) * LEAF
        return [t for i in range(0, len(rows), size) for t in tile(rows[i : i + size], at + 1)]

    # components that spread the rows most come first
    spread = np.argsort(-vectors.var(axis=0), kind="stable")
    return np.concatenate(tile(np.arange(len(vectors)), 0))


def _packer(dimensions: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of the rows, which come sorted by label."""
        most = max(LEAF, BLOCK // (8 * dimensions))
        number = TaskContext.get().partitionId() << 32
        label, ids, vectors = None, np.empty(0, np.int64), np.empty((0, dimensions))

        def block(n: int) -> pa.RecordBatch:
            nonlocal number
            number += 1
            order = tiled(vectors[:n])
            arrays = [[number - 1], [label], [ids[order].tobytes()], [vectors[order].tobytes()]]
            kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], names=["block", "label", "ids", "vectors"])

        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), object)
            column = batch.column("vector")
            sizes = np.diff(column.offsets.to_numpy())
            table = np.zeros((len(sizes), dimensions))
            inside = np.arange(dimensions) < sizes[:, None]
            table[inside] = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
            cuts = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if label is not None and labels[a] != label and len(ids):
                    yield block(len(ids))
                    ids, vectors = ids[:0], vectors[:0]
                label = labels[a]
                ids, vectors = np.append(ids, batch.column("id").to_numpy()[a:b]), np.concatenate([vectors, table[a:b]])
                while len(ids) >= most:
                    yield block(most)
                    ids, vectors = ids[most:], vectors[most:]
        if len(ids):
            yield block(len(ids))

    return pack


class Trees:
    """The R-trees of a stripe, their nodes in one list."""

    def __init__(self, blocks: list[tuple[str, np.ndarray, np.ndarray]]) -> None:
        self.roots: list[tuple[str, int]] = []
        self.children: list[tuple[int, int]] = []  # rows of a leaf, nodes of others
        self.leaves: list[bool] = []
        self.ids = np.concatenate([b[1] for b in blocks])
        self.vectors = np.concatenate([b[2] for b in blocks])
        low, high, at = [], [], 0
        for label, ids, vectors in blocks:
            begin = np.arange(0, len(ids), LEAF)
            lows, highs = np.minimum.reduceat(vectors, begin), np.maximum.reduceat(vectors, begin)
            first = len(self.children)
            self.children += [(at + b, at + min(b + LEAF, len(ids))) for b in begin.tolist()]
            self.leaves += [True] * len(begin)
            low.append(lows), high.append(highs)
            while len(lows) > 1:
                begin = np.arange(0, len(lows), FANOUT)
                nodes = [(first + b, first + min(b + FANOUT, len(lows))) for b in begin.tolist()]
                first = len(self.children)
                self.children += nodes
                self.leaves += [False] * len(begin)
                lows, highs = np.minimum.reduceat(lows, begin), np.maximum.reduceat(highs, begin)
                low.append(lows), high.append(highs)
            self.roots.append((label, len(self.children) - 1))
            at += len(ids)
        self.low, self.high = np.concatenate(low), np.concatenate(high)
        self.largest = float(np.abs(self.vectors).max(initial=0))

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends of the scores of each anchor (row) with the rows in each node (column)."""
        rising, falling = np.maximum(anchors, 0), np.minimum(anchors, 0)
        with np.errstate(over="ignore", invalid="ignore"):
            low = rising @ self.low.T + falling @ self.high.T
            high = rising @ self.high.T + falling @ self.low.T
            reach = anchors.shape[1] * self.largest * np.abs(anchors).max(axis=1, initial=0)[:, None]
            room = np.where(reach < 2.0**53, 0, reach * anchors.shape[1] * 2.0**-50)
            low, high = low - room, high + room
        low, high = np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)
        return np.minimum(low, np.nextafter(2.0**63, 0)), np.maximum(high, -(2.0**63))  # as scores are

    def scores(self, anchor: np.ndarray, a: int, b: int) -> np.ndarray:
        rows = self.vectors[a:b]
        if len(anchor) * self.largest * np.abs(anchor).max(initial=0) < 2.0**53:
            return (rows @ anchor).astype(np.int64)
        whole = [int(x) for x in anchor.tolist()]
        sums = [sum(int(x) * y for x, y in zip(r, whole, strict=True)) for r in rows.tolist()]
        return np.array([min(max(s, LONGS[0]), LONGS[1]) for s in sums], np.int64)

    def best(
        self, anchor: np.ndarray, own: int, roots: list[int], low: list[float], high: list[float], windows: list[tuple[int, int]], k: int
    ) -> list[list[tuple[int, int]]]:
        """For each window of scores the first ``k`` rows ``-score, id`` in it, without the row ``own``."""
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        least = [a for a, _ in windows]  # a row must reach it to be wanted
        queue = [(-high[r], r) for r in roots]
        heapq.heapify(queue)
        while queue:
            upper, node = heapq.heappop(queue)
            upper = -upper
            wanted = [w for w, (_, top) in enumerate(windows) if upper >= least[w] and low[node] <= top]
            if not wanted:
                if upper < min(least):
                    break
                continue
            a, b = self.children[node]
            if not self.leaves[node]:
                floor = min(least[w] for w in wanted)
                for child in range(a, b):
                    if high[child] >= floor:
                        heapq.heappush(queue, (-high[child], child))
                continue
            scores = self.scores(anchor, a, b)
            if scores.max() < min(least[w] for w in wanted):
                continue
            pairs = list(zip(scores.tolist(), self.ids[a:b].tolist(), strict=True))
            for w in wanted:
                top, one = windows[w][1], found[w]
                for score, key in pairs:
                    if least[w] <= score <= top and key != own:
                        insort(one, (-score, key))
                        if len(one) >= k:
                            del one[k:]
                            least[w] = -one[-1][0]
        return found


def _searcher(same: bool, k: int, low: int, high: int):
    """Search each stripe: its blocks come first, then the anchors, each with its positives unless these are wanted."""

    def windows(scores: list[int]) -> list[tuple[int, int]]:
        return [LONGS] if same else [(-(-low * s // 100), high * s // 100) for s in scores]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripe, blocks, trees = None, [], None
        for batch in batches:
            stripes, asks = batch.column("stripe").to_numpy(), batch.column("ask").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((stripes[1:] != stripes[:-1]) | (asks[1:] != asks[:-1])) + 1).tolist(), len(stripes)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if stripes[a] != stripe:
                    stripe, blocks, trees = stripes[a], [], None
                part = batch.slice(a, b - a)
                if not asks[a]:
                    for row in part.select(["label", "ids", "vectors"]).to_pylist():
                        ids = np.frombuffer(row["ids"], np.int64)
                        blocks.append((row["label"], ids, np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1)))
                    continue
                if not blocks:
                    continue
                trees = trees or Trees(blocks)
                for i in range(0, b - a, ASKS):
                    rows = part.slice(i, ASKS).to_pylist()
                    anchors = np.stack([np.frombuffer(r["vectors"], np.float64) for r in rows])
                    ends = [e.tolist() for e in trees.intervals(anchors)]
                    out: list[tuple] = []
                    for j, row in enumerate(rows):
                        roots = [root for label, root in trees.roots if (label == row["label"]) == same]
                        scores = row["scores"] or []
                        found = trees.best(anchors[j], row["id"], roots, ends[0][j], ends[1][j], windows(scores), k)
                        named = zip(row["positives"] or [None], scores or [None], found, strict=True)
                        out += [(row["id"], p, key, s, -score) for p, s, rows_ in named for score, key in rows_]
                    if out:
                        columns = zip(zip(*out, strict=True), _FOUND, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=_FOUND)

    return search


def packed(rows: DataFrame, dimensions: int) -> DataFrame:
    """Blocks of the rows ``id, label, vector``."""
    order = ["label", "__first", "id"]
    dealt = rows.withColumn("__first", F.get("vector", F.lit(0))).repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("id", "label", "vector").mapInArrow(_packer(dimensions), BLOCKS)


def search(blocks: DataFrame, asks: DataFrame, stripes: int, same: bool, k: int, low: int = 0, high: int = 100) -> DataFrame:
    """The best rows of each stripe for the anchors ``id, label, vectors, positives, scores``."""
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none = F.lit(None).cast("array<bigint>")
    stripe = F.pmod(F.xxhash64("block"), F.lit(stripes)).cast("int")
    held = blocks.select(
        stripe.alias("stripe"), F.lit(False).alias("ask"), F.lit(None).cast("bigint").alias("id"), "label", "ids", "vectors",
        none.alias("positives"), none.alias("scores"),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))
    asked = asks.select(
        every.alias("stripe"), F.lit(True).alias("ask"), "id", "label", F.lit(None).cast("binary").alias("ids"), "vectors", "positives", "scores"
    )
    dealt = held.unionByName(asked).repartition(parts, "stripe").sortWithinPartitions("stripe", "ask")
    return dealt.mapInArrow(_searcher(same, k, low, high), FOUND)


def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _members(vectors: DataFrame, key: str, label: Column, vector: str) -> DataFrame:
    """``id, label, vector`` of the rows that take part, once for each identifier."""
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), label.cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * SCALE) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)
    repeated = rows.groupBy("id").count().where("count > 1").select("id")
    if repeated.isEmpty():
        return rows
    once, more = rows.join(repeated, "id", "left_anti"), rows.join(repeated, "id", "left_semi")
    one = more.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("one")).select("id", "one.label", "one.vector")
    return once.unionByName(one)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column | None = None,
    key: str = "vec_id",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``anchors`` (of ``id``) holds."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "negatives")
    rows = _members(vectors, key, F.col("label") if label is None else label, vector)
    dimensions = max(1, rows.agg(F.max(F.size("vector")).alias("n")).first()["n"] or 1)
    blocks = scratch.store(packed(rows, dimensions), "blocks")
    count = blocks.count()
    stripes = max(1, min(count, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-count // HELD))
    own = rows.where(anchors).select("id", "label", "vector").mapInArrow(_anchor(dimensions), "id bigint, label string, vectors binary")
    own = scratch.store(own, "anchors")
    none = F.lit(None).cast("array<bigint>")
    found = search(blocks, own.withColumns({"positives": none, "scores": none}), stripes, True, positives)
    best = scratch.store(ranked(found, ["anchor_id"], positives).select(F.col("anchor_id").alias("id"), F.col("id").alias("positive"), "score"), "positives")
    pairs = F.sort_array(F.collect_list(F.struct("positive", "score")))
    lists = best.groupBy("id").agg(pairs.alias("pairs")).select("id", F.col("pairs.positive").alias("positives"), F.col("pairs.score").alias("scores"))
    found = search(blocks, own.join(lists, "id"), stripes, False, negatives, low, high)
    return ranked(found, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def _anchor(dimensions: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.zeros((batch.num_rows, dimensions))
            column = batch.column("vector")
            table[np.arange(dimensions) < np.diff(column.offsets.to_numpy())[:, None]] = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
            arrays = [batch.column("id"), batch.column("label"), pa.array([r.tobytes() for r in table], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "label", "vectors"])

    return rows


def negative_report(vectors: DataFrame) -> DataFrame:
    """Anchors: identifiers divisible by 100. Where an identifier is divisible by 7, the label first becomes the next of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint"))
    return hard_negatives(vectors, F.col("id") % 100 == 0, label)
