"""Approximate nearest neighbours by multiprobe p-stable hashing.

A hash function is floor((a.x + b) / w) with normal a and uniform b; a table's bucket joins several. A query
visits, in each table, its own bucket and those reached by moving some hash values by one, in the order
of estimated success: the sum of squared distances to the borders crossed, by its expectation for the
order of the query's own border distances. Vectors met in any table are ranked by exact distance.

Fitting. For ``SAMPLE_QUERIES`` queries the exact neighbours among all rows are found first, by blocks. Of
a grid of functions per table, widths and numbers of probes, the cheapest is taken that finds ``TARGET`` of
these neighbours; cost counts distances (by ``SAMPLE_ROWS`` sampled rows) and visits. Every row is indexed.

Work. Equal vectors are one row with their 11 smallest identifiers, so a common vector is searched once.
Index rows and visits are dealt and sorted by bucket, and a task streams its buckets: visits first,
then blocks of vectors, of which the 11 nearest of each visit stay. Rough distances of a block only rule out
vectors farther than the 11th nearest by more than rounding can make; all others, however many tie there,
are ranked by exact distance and identifier. No pairs are written down but those that stay.
Buckets with more than ``BLOCK`` vectors or ``VISITS`` visits are cut into parts of these sizes, and each
part of the vectors meets each part of the visits in a task of its own. Queries for which fewer
than 10 were found are searched again among all rows, in blocks.

Defined cases: vectors that are null, zero, hold null or non-finite components or have another length
than most take no part, nor do null identifiers; rows repeated with the same identifier and vector count
once; ties go to the smaller identifier; with fewer than 10 candidates all are returned; an empty table
gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lapsewise.llm.words import uniform
from lapsewise.sources.workspace import Scratch

NEAREST = 10
TABLES = 6
FUNCTIONS = (2, 4, 6, 8, 10, 12, 16)
WIDTHS = (1.0, 1.5, 2.0, 3.0)
PROBES = (8, 16, 32, 64, 128, 256)
TARGET = 0.95
VISIT_COST = 100  # distances
SAMPLE_ROWS, SAMPLE_QUERIES = 2000, 64
BLOCK, VISITS = 1 << 14, 1 << 12
PAIRS = 1 << 21  # numbers held while exact distances are computed
ROUNDING = 16 * float(np.finfo(np.float64).eps)
SEED = 7
ROWS = "bucket bigint, part int, query boolean, rep bigint, vector binary"
FOUND = "query bigint, rep bigint, distance double"


def probe_order(functions: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of borders to cross, cheapest first. Border j is the j-th nearest (from 1) of a query's 2 * ``functions``."""
    m, cost = functions, [0.0]
    for j in range(1, 2 * m + 1):
        k = 2 * m + 1 - j
        near = j * (j + 1) / (4 * (m + 1) * (m + 2))
        cost.append(near if j <= m else 1 - k / (m + 1) + k * (k + 1) / (4 * (m + 1) * (m + 2)))
    found, heap = [()], [(cost[1], (1,))]
    while heap and len(found) < probes:
        total, borders = heapq.heappop(heap)
        if all(2 * m + 1 - j not in borders for j in borders):  # not both borders of one function
            found.append(borders)
        last = borders[-1]
        if last < 2 * m:
            heapq.heappush(heap, (total + cost[last + 1], (*borders, last + 1)))
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*borders[:-1], last + 1)))
    return found


@dataclass(frozen=True)
class Tables:
    """Hash tables: everything but the seed and four numbers follows by rule."""

    dimensions: int
    functions: int
    width: float
    probes: int
    seed: int = SEED

    def _places(self, table: int, vectors: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng([self.seed, table, self.functions])
        ways = rng.standard_normal((self.dimensions, self.functions))
        return vectors @ ways / self.width + rng.uniform(0, 1, self.functions)

    def _bucket(self, table: int, values: np.ndarray) -> np.ndarray:
        factors = np.random.default_rng([self.seed, table, 1]).integers(1, 2**62, self.functions) | 1
        return (values * factors).sum(axis=-1) ^ (table << 56)

    def buckets(self, table: int, vectors: np.ndarray) -> np.ndarray:
        return self._bucket(table, np.floor(self._places(table, vectors)).astype(np.int64))

    def visits(self, table: int, vectors: np.ndarray) -> np.ndarray:
        """Buckets to visit, best first: a row for each vector."""
        places = self._places(table, vectors)
        values = np.floor(places).astype(np.int64)
        inside = places - values
        order = np.argsort(np.concatenate([inside, 1 - inside], axis=1), axis=1, kind="stable")
        rows, columns = np.arange(len(vectors)), []
        for borders in probe_order(self.functions, self.probes):
            moved = values.copy()
            for j in borders:
                which = order[:, j - 1]
                moved[rows, which % self.functions] += np.where(which < self.functions, -1, 1)
            columns.append(self._bucket(table, moved))
        return np.stack(columns, axis=1)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dimensions)


def _spread(tables: Tables, query: bool, narrow: bool = False):
    """Rows of a table of vectors for all hash tables: buckets of vectors, or visits of queries."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                vectors = _matrix(part.column("vector"), tables.dimensions)
                for table in range(TABLES):
                    found = tables.visits(table, vectors) if query else tables.buckets(table, vectors)[:, None]
                    places = pa.array(np.repeat(np.arange(len(vectors)), found.shape[1]))
                    arrays, names = [pa.array(found.ravel()), pa.array(np.full(found.size, query))], ["bucket", "query"]
                    if not narrow:
                        arrays += [part.column(c).take(places) for c in ("rep", "vector")]
                        names += ["rep", "vector"]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return spread


def _search(dimensions: int):
    """Nearest ``NEAREST`` + 1 vectors of each visit in its bucket; rows come by bucket and part, visits first."""
    keep = NEAREST + 1

    def exact(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        return np.sqrt(((queries - vectors) ** 2).sum(axis=-1))

    def merged(state: list, reps: np.ndarray, vectors: np.ndarray) -> None:
        ids, queries, best_reps, best = state
        for low in range(0, len(reps), 4096):
            r, x = reps[low : low + 4096], vectors[low : low + 4096]
            lengths = (x * x).sum(axis=1)
            longest = np.sqrt(lengths.max())
            for q in range(0, len(ids), 256):
                asked, farthest = queries[q : q + 256], best[q : q + 256, -1]
                own = (asked * asked).sum(axis=1)
                rough = lengths - 2 * (asked @ x.T)
                # every vector that may be among the nearest, ties and rounding of both distances included
                bound = ROUNDING * (dimensions + 4) * (np.sqrt(own) + longest) ** 2
                limit = farthest**2 - own
                if len(r) > keep:
                    limit = np.minimum(limit, np.partition(rough, keep - 1, axis=1)[:, keep - 1])
                rows, columns = np.nonzero(~(rough > (limit + bound)[:, None]))
                if not len(rows):
                    continue
                step = max(1, PAIRS // dimensions)
                distances = [exact(asked[rows[i : i + step]], x[columns[i : i + step]]) for i in range(0, len(rows), step)]
                touched = np.unique(rows)
                all_rows = np.concatenate([np.repeat(touched, keep), rows])
                all_reps = np.concatenate([best_reps[q + touched].ravel(), r[columns]])
                all_d = np.concatenate([best[q + touched].ravel(), *distances])
                order = np.lexsort((all_reps, all_d, all_rows))
                first = np.searchsorted(all_rows[order], touched)
                order = order[first[:, None] + np.arange(keep)]
                best_reps[q + touched], best[q + touched] = all_reps[order], all_d[order]

    def out(state: list) -> pa.RecordBatch:
        ids, _, best_reps, best = state
        rows, columns = np.nonzero(np.isfinite(best))
        arrays = [pa.array(ids[rows]), pa.array(best_reps[rows, columns]), pa.array(best[rows, columns])]
        return pa.RecordBatch.from_arrays(arrays, names=["query", "rep", "distance"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            buckets, parts, asks, reps = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "part", "query", "rep"))
            change = np.flatnonzero((buckets[1:] != buckets[:-1]) | (parts[1:] != parts[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *change], [*change, len(buckets)], strict=True):
                if (buckets[a], parts[a]) != key:
                    if state:
                        yield out(state)
                    key, state = (buckets[a], parts[a]), None
                if not asks[a] and state is None:
                    continue  # a bucket nobody visits
                vectors = _matrix(batch.column("vector").slice(a, b - a), dimensions)
                if asks[a]:
                    new = [reps[a:b], vectors, np.full((b - a, keep), -1, np.int64), np.full((b - a, keep), np.inf)]
                    state = new if state is None else [np.concatenate(x) for x in zip(state, new, strict=True)]
                else:
                    merged(state, reps[a:b], vectors)
        if state:
            yield out(state)

    return search


def _dealt(rows: DataFrame, dimensions: int) -> DataFrame:
    """Search the rows bucket by bucket."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartition(parts, "bucket", "part").sortWithinPartitions("bucket", "part", F.desc("query"))
    return sorted_.select("bucket", "part", "query", "rep", "vector").mapInArrow(_search(dimensions), FOUND)


def search_all(base: DataFrame, queries: DataFrame, dimensions: int, blocks: int) -> DataFrame:
    """Exact neighbours of the queries among all of ``base``, in so many blocks, each for up to about ``VISITS`` queries."""
    block = F.pmod(F.xxhash64("rep"), F.lit(blocks))
    shares = max(1, -(-queries.count() // VISITS))
    share = F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
    rows = base.select(block.alias("bucket"), share.alias("part"), F.lit(False).alias("query"), "rep", "vector")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    own = F.pmod(F.xxhash64("rep"), F.lit(shares)).cast("int")
    asks = queries.select(every.alias("bucket"), own.alias("part"), F.lit(True).alias("query"), "rep", "vector")
    return _nearest(_dealt(rows.unionByName(asks), dimensions))


def _nearest(found: DataFrame) -> DataFrame:
    """The nearest ``NEAREST`` + 1 different vectors of each query."""
    order = Window.partitionBy("query").orderBy("distance", "rep")
    each = found.groupBy("query", "rep").agg(F.min("distance").alias("distance"))
    return each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= NEAREST + 1).drop("place")


def search_tables(base: DataFrame, queries: DataFrame, tables: Tables, scratch: Scratch) -> DataFrame:
    """Neighbours of the queries in the buckets they visit."""
    narrow = [df.mapInArrow(_spread(tables, q, narrow=True), "bucket bigint, query boolean") for df, q in ((base, False), (queries, True))]
    sizes = narrow[0].unionByName(narrow[1]).groupBy("bucket").agg(F.count_if("query").alias("visits"), F.count_if(~F.col("query")).alias("vectors"))
    large = sizes.where((F.col("visits") > 0) & ((F.col("vectors") > BLOCK) | (F.col("visits") > VISITS)))
    large = large.select("bucket", F.ceil(F.col("vectors") / BLOCK).cast("int").alias("v"), F.ceil(F.col("visits") / VISITS).cast("int").alias("q"))
    large = scratch.store(large, "large-buckets")

    def rows(df: DataFrame, query: bool) -> DataFrame:
        spread = df.mapInArrow(_spread(tables, query), "bucket bigint, query boolean, rep bigint, vector binary").join(large, "bucket", "left")
        v, q = F.coalesce("v", F.lit(1)), F.coalesce("q", F.lit(1))
        own, others = (q, v) if query else (v, q)
        mine = F.pmod(F.xxhash64("rep"), own)
        other = F.explode(F.sequence(F.lit(0), F.greatest(others, F.lit(1)) - 1))
        spread = spread.select("*", mine.cast("int").alias("mine"), other.alias("other"))
        part = F.col("other") * q + F.col("mine") if query else F.col("mine") * q + F.col("other")
        return spread.select("bucket", part.cast("int").alias("part"), "query", "rep", "vector")

    return _nearest(_dealt(rows(base, False).unionByName(rows(queries, True)), tables.dimensions))


def fit(base: DataFrame, queries: DataFrame, dimensions: int, scratch: Scratch) -> Tables:
    """The cheapest tables that find ``TARGET`` of the exact neighbours of some queries."""
    spark, n = base.sparkSession, max(1, base.count())
    draw = uniform(F.col("rep"), SEED)
    asked = queries.orderBy(draw, "rep").limit(SAMPLE_QUERIES)
    asked = scratch.store(asked, "sample-queries")
    exact = search_all(base, asked, dimensions, _blocks(spark, n))
    near = scratch.store(exact.where("rep != query").join(base.select("rep", "vector"), "rep"), "sample-neighbours").toArrow()
    some = base.where(draw < min(1.0, SAMPLE_ROWS / n)).select("vector").toArrow()
    asks = asked.toArrow()
    if not near.num_rows:
        return Tables(dimensions, FUNCTIONS[0], 1.0, PROBES[0])
    places = {r: i for i, r in enumerate(asks["rep"].to_pylist())}
    which = np.array([places[r] for r in near["query"].to_pylist()])
    q, x, y = (_matrix(t["vector"].combine_chunks(), dimensions) for t in (asks, near, some))
    scale = float(np.median(near["distance"].to_numpy())) or 1.0
    best = None
    for functions in FUNCTIONS:
        for width in WIDTHS:
            tables = Tables(dimensions, functions, width * scale, PROBES[-1])
            found, met = np.full(len(x), PROBES[-1] + 1), np.full((len(q), len(y)), PROBES[-1] + 1)  # place of the first visit
            for table in range(TABLES):
                visits = tables.visits(table, q)
                here, there = tables.buckets(table, x), tables.buckets(table, y)
                hit = visits[which] == here[:, None]
                found = np.where(hit.any(axis=1), np.minimum(found, hit.argmax(axis=1)), found)
                for i, row in enumerate(visits):
                    order = np.argsort(row, kind="stable")
                    at = np.minimum(np.searchsorted(row[order], there), len(row) - 1)
                    same = row[order][at] == there
                    met[i, same] = np.minimum(met[i, same], order[at][same])
            for probes in PROBES:
                if (found < probes).mean() >= TARGET:
                    cost = (met < probes).mean() * n + TABLES * probes * VISIT_COST
                    if best is None or cost < best[0]:
                        best = cost, Tables(dimensions, functions, width * scale, probes)
                    break
    return best[1] if best else Tables(dimensions, FUNCTIONS[0], max(WIDTHS) * scale, PROBES[-1])


def _blocks(spark: SparkSession, n: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BLOCK))


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("vector")
        flat = column.flatten().to_numpy(zero_copy_only=False).astype("<f8")
        ends = np.diff(column.offsets.to_numpy()).cumsum()[:-1]
        packed = [v.tobytes() for v in np.split(flat, ends)] if len(column) else []
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column("id")], names=["vector", "id"])


def nearest(vectors: DataFrame, asked: Column, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Neighbours of the rows for which ``asked`` (a condition on ``id``) holds, with what they were found among.

    Gives ``query_id, rank, vec_id, score`` with ``rank`` from 1 to ``NEAREST``; the distinct vectors
    ``rep, vector, ids``; and those of the queries.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "neighbours")
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dimensions = common["n"] if common else 1
    packed = rows.where(F.size("vector") == dimensions).select("vector", "id").mapInArrow(_pack, "vector binary, id bigint")
    packed = scratch.store(packed.distinct(), "packed")
    first = Window.partitionBy("vector").orderBy("id")
    few = packed.withColumn("place", F.row_number().over(first)).where(F.col("place") <= NEAREST + 1)
    base = few.groupBy("vector").agg(F.min("id").alias("first"), F.array_sort(F.collect_list("id")).alias("ids"))
    # numbered in the order of their smallest identifiers, by which ties go; one identifier may have several vectors
    base = base.repartitionByRange("first", "vector").sortWithinPartitions("first", "vector")
    base = scratch.store(base.withColumn("rep", F.monotonically_increasing_id()), "base")
    own = packed.where(asked).join(base.select("vector", "rep"), "vector").select("id", "rep")
    own = scratch.store(own, "asked")
    queries = scratch.store(base.join(own.select("rep").distinct(), "rep", "left_semi").select("rep", "vector"), "queries")
    tables = fit(base.select("rep", "vector"), queries, dimensions, scratch)
    found = scratch.store(search_tables(base.select("rep", "vector"), queries, tables, scratch), "found")
    total = base.count()
    short = found.groupBy("query").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min(NEAREST, total - 1))
    short = scratch.store(queries.join(short, F.col("rep") == F.col("query"), "left_anti").select("rep", "vector"), "short")
    if not short.isEmpty():
        again = search_all(base.select("rep", "vector"), short, dimensions, _blocks(spark, total))
        found = found.join(short.select(F.col("rep").alias("query")), "query", "left_anti").unionByName(again)
    members = found.join(base.select("rep", "ids"), "rep").select("query", "distance", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy("distance", "vec_id")
    members = members.withColumn("place", F.row_number().over(order)).where(F.col("place") <= NEAREST + 1)
    lists = members.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("distance", "vec_id"))).alias("near"))
    lists = scratch.store(lists, "lists")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, NEAREST)
    ranked = own.join(lists, F.col("rep") == F.col("query")).select("id", F.posexplode(others).alias("place", "one"))
    result = ranked.select(
        F.col("id").alias("query_id"), (F.col("place") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"), F.col("one.distance").alias("score")
    )
    return result, base, queries


def neighbour_report(vectors: DataFrame) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose identifier is divisible by 100, against all others."""
    return nearest(vectors, F.col("id") % 100 == 0)[0]
