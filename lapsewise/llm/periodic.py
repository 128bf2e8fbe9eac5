"""Stretches of words that repeat with a period, found on a grammar of the text.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and a
length of at least max(``LEAST``, ``TIMES`` * q) that no neighbouring word extends keeping the period.

1. Re-Pair. The word ids of a block of whole documents become a grammar: in every round the pairs of
   neighbours that are more frequent than the pairs they overlap are replaced by a nonterminal each; pairs
   never cross documents, documents share nonterminals. What no pair shortens any more is joined two by two.
2. Boundaries. A run lies in a lowest nonterminal that holds all of it, and crosses the boundary of its two parts.
   At least half of it lies on one side of the boundary, so the four words on that side occur again q words on:
   such places are the candidate periods. How far each reaches is found by bisection over prefix hashes. Each
   nonterminal is looked at once, however often it occurs.
3. Positions. Found runs are carried to all places of their nonterminal in the derivation; those of one period
   that overlap merge to maximal intervals. Every interval is then compared word by word, so that hashes decide
   nothing; should two ever collide, the block is done again with other hashes.

Documents stay in the tasks that read them: no shuffle. A task holds one block of ``BLOCK`` bytes, or one longer text.

Defined cases: a null text is empty and has no words and no runs; a null identifier is never rewritten; repeated
rows each give a row; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LEAST, TIMES = 24, 3
GRAM = 4  # words known to repeat beside the boundary: max(LEAST / 2 - q, q / 2) for the least favourable q
BLOCK = 1 << 21
PAIRS = 1 << 20
SLOWEST = 1024  # rounds end when they shorten the sequence by less than this part
PRIMES = (2**31 - 1, 2**31 - 19)
REPORT = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


class Grammar:
    """Rules ``left, right`` of the nonterminals, with their length and first place; roots by document."""

    def __init__(self, words: np.ndarray, documents: np.ndarray) -> None:
        """``words``: ids of all words; ``documents``: the document of each, ascending."""
        n = int(words.max()) + 1 if len(words) else 0
        self.terminals, self.size = n, n
        self.left, self.right, self.length, self.first = ([np.full(n, x, np.int64)] for x in (-1, -1, 1, -1))
        self._sequence, self._document, self._start = words.astype(np.int64), documents, np.arange(len(words))
        while self._round():
            pass
        while self._join():
            pass
        self.left, self.right, self.length, self.first = map(np.concatenate, (self.left, self.right, self.length, self.first))
        self.roots, self.places = self._sequence, self._start

    def _replace(self, at: np.ndarray) -> None:
        """Replace the pairs that begin at the places, which don't overlap."""
        s = self._sequence
        pairs, first, which = np.unique(s[at] * self.size + s[at + 1], return_index=True, return_inverse=True)
        lengths = np.concatenate(self.length)
        left, right = pairs // self.size, pairs % self.size
        self.left.append(left), self.right.append(right), self.first.append(self._start[at[first]])
        self.length = [lengths, lengths[left] + lengths[right]]
        s[at] = self.size + which
        self.size += len(pairs)
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        self._sequence, self._document, self._start = s[keep], self._document[keep], self._start[keep]

    def _round(self) -> bool:
        s, n = self._sequence, len(self._sequence)
        if n < 2:
            return False
        pairs = np.where(self._document[1:] == self._document[:-1], s[:-1] * self.size + s[1:], -1)
        different, which, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        counts[(different < 0) | (counts < 2)] = 0
        rank = np.where(counts[which] > 0, counts[which] * len(different) + which, 0)
        # equal neighbours are one pair of a symbol with itself: every second place of such a stretch
        begin = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
        value = rank[begin]
        before, after = np.concatenate([[0], value[:-1]]), np.concatenate([value[1:], [0]])
        group = np.cumsum(np.bincount(begin, minlength=n - 1)) - 1
        good = (value > 0) & (value > before) & (value > after)
        at = np.flatnonzero(good[group] & ((np.arange(n - 1) - begin[group]) % 2 == 0))
        at = at[np.bincount(which[at], minlength=len(different))[which[at]] > 1]
        if len(at):
            self._replace(at)
        return len(at) * SLOWEST > n

    def _join(self) -> bool:
        """Join the symbols of each document two by two."""
        d = self._document
        begin = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]])) if len(d) else np.empty(0, np.int64)
        offset = np.arange(len(d)) - np.repeat(begin, np.diff(np.append(begin, len(d))))
        at = np.flatnonzero((offset[:-1] % 2 == 0) & (d[1:] == d[:-1]))
        if len(at):
            self._replace(at)
        return bool(len(at))


class _Reach:
    """How far two places agree, by prefix hashes."""

    def __init__(self, words: np.ndarray, seed: int) -> None:
        self.sides, bases = [], np.random.default_rng(seed).integers(1 << 20, 1 << 30, len(PRIMES))
        for prime, base in zip(PRIMES, bases.tolist(), strict=True):
            powers, n = np.ones(len(words) + 1, np.int64), 1
            while n < len(powers):
                powers[n : 2 * n] = powers[: len(powers[n : 2 * n])] * pow(base, n, prime) % prime
                n *= 2
            sums = np.concatenate([[0], np.cumsum((words + 1) * powers[:-1] % prime)]) % prime
            self.sides.append((prime, powers, sums))

    def same(self, i: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from i on equal those q words later."""
        good = np.ones(len(i), bool)
        for prime, powers, sums in self.sides:
            here, there = (sums[i + n] - sums[i]) % prime, (sums[i + q + n] - sums[i + q]) % prime
            good &= here * powers[q] % prime == there
        return good

    def _longest(self, most: np.ndarray, good: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = good(middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low

    def ahead(self, i: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        return self._longest(most, lambda n: self.same(i, q, n))

    def behind(self, i: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        return self._longest(most, lambda n: self.same(i - n, q, n))


def _spelled(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All numbers from low to high of every row, with the row, at most about ``PAIRS`` at once."""
    counts = np.maximum(high - low, 0)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, total, PAIRS):
        number = np.arange(begin, min(begin + PAIRS, total))
        row = np.searchsorted(ends, number, "right")
        yield row, low[row] + number - (ends[row] - counts[row])


def _crossing(words: np.ndarray, grammar: Grammar, seed: int) -> np.ndarray:
    """``symbol, start, end, period`` of the runs across the boundary of each nonterminal, by its first place."""
    n = len(words)
    symbol = np.flatnonzero(grammar.length >= LEAST)
    symbol = symbol[symbol >= grammar.terminals]
    if not len(symbol):
        return np.empty((0, 4), np.int64)
    begin, size = grammar.first[symbol], grammar.length[symbol]
    end, cut = begin + size, begin + grammar.length[grammar.left[symbol]]
    grams = np.zeros(n - GRAM + 1, np.uint64)
    for j in range(GRAM):
        grams = (grams + words[j : n - GRAM + 1 + j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
    gram = np.unique(grams, return_inverse=True)[1].astype(np.int64)
    keys = np.sort(gram * n + np.arange(len(gram)))
    reach, found = None, []
    for right in (True, False):
        own = cut if right else cut - GRAM
        rows = np.flatnonzero((own >= begin) & (own + GRAM <= end))
        at, g = own[rows], gram[own[rows]] * n
        if right:
            lowest, highest = at + 1, np.minimum(end[rows] - GRAM, at + size[rows] // TIMES)
        else:
            lowest, highest = np.maximum(begin[rows], at - size[rows] // TIMES), at - 1
        low, high = np.searchsorted(keys, g + lowest, "left"), np.searchsorted(keys, g + highest, "right")
        for row, place in _spelled(low, np.where(highest >= lowest, high, low)):
            row, other = rows[row], keys[place] % n
            q = np.abs(other - own[row])
            # so many words beside the boundary must repeat; the last of them first
            needed = np.maximum(LEAST // 2 - q, (q + 1) // 2)
            room = cut[row] + needed + q <= end[row] if right else cut[row] - needed - q >= begin[row]
            row, q, needed = row[room], q[room], needed[room]
            far = cut[row] + needed - 1 if right else cut[row] - needed
            match = words[far] == words[far + q if right else far - q]
            row, q = row[match], q[match]
            if not len(row):
                continue
            reach = reach or _Reach(words, seed)
            i = cut[row] if right else cut[row] - q
            ahead = reach.ahead(i, q, end[row] - i - q)
            start = i - reach.behind(i, q, i - begin[row])
            stop = i + q + ahead
            good = (start < cut[row]) & (stop > cut[row]) & (stop - start >= np.maximum(LEAST, TIMES * q))
            found.append(np.stack([symbol[row], start - begin[row], stop - begin[row], q], axis=1)[good])
    found = np.concatenate(found) if found else np.empty((0, 4), np.int64)
    # of the periods of a stretch the smallest
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    return found[first]


def _placed(grammar: Grammar, runs: np.ndarray) -> np.ndarray:
    """``period, start, end`` of the runs at all places of their symbols."""
    symbol, place, found = grammar.roots, grammar.places, [np.empty((0, 3), np.int64)]
    while len(symbol):
        low, high = np.searchsorted(runs[:, 0], symbol, "left"), np.searchsorted(runs[:, 0], symbol, "right")
        for row, at in _spelled(low, high):
            found.append(np.stack([runs[at, 3], place[row] + runs[at, 1], place[row] + runs[at, 2]], axis=1))
        inner = (grammar.length[symbol] >= LEAST) & (symbol >= grammar.terminals)
        symbol, place = symbol[inner], place[inner]
        left, right = grammar.left[symbol], grammar.right[symbol]
        symbol, place = np.concatenate([left, right]), np.concatenate([place, place + grammar.length[left]])
        long = grammar.length[symbol] >= LEAST
        symbol, place = symbol[long], place[long]
    return np.unique(np.concatenate(found), axis=0)


def _merged(placed: np.ndarray) -> list[tuple[int, int, int]]:
    """``start, end, period``: intervals of a period that share as many words as it has are one."""
    merged: list[list[int]] = []
    for period, start, end in placed.tolist():
        if merged and merged[-1][2] == period and start + period <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, period])
    return [tuple(m) for m in merged]


def _exact(words: np.ndarray, documents: np.ndarray, run: tuple[int, int, int]) -> bool:
    start, end, q = run
    if not np.array_equal(words[start : end - q], words[start + q : end]):
        return False
    before = start > 0 and documents[start - 1] == documents[start] and words[start - 1] == words[start - 1 + q]
    after = end < len(words) and documents[end] == documents[start] and words[end] == words[end - q]
    return not before and not after


def runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of the runs of each text (a list of words), by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n = int(sizes.sum())
    if n < LEAST:
        return found
    every = np.empty(n, object)
    every[:] = [w for t in texts for w in t]
    words = pd.factorize(every)[0].astype(np.int64)
    documents, begin = np.repeat(np.arange(len(texts)), sizes), np.cumsum(sizes) - sizes
    grammar, seed = Grammar(words, documents), 0
    while True:
        intervals = _merged(_placed(grammar, _crossing(words, grammar, seed)))
        if all(_exact(words, documents, run) for run in intervals):
            break
        seed += 1
    for start, end, period in sorted(intervals, key=lambda r: (r[0], r[2])):
        document = int(documents[start])
        found[document].append((start - int(begin[document]), end - start, period))
    return found


def planted(words: list[bytes], key: int | None) -> list[bytes]:
    """The words, for a tenth of the identifiers with a tail that repeats."""
    n, h = len(words), zlib.crc32(str(key).encode())
    if key is None or n == 0 or h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _summary(words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    """The columns of the report after ``doc_id``."""
    best = None
    for run in found:
        if best is None or (run[1] * best[2], -run[0], -run[2]) > (best[1] * run[2], -best[0], -best[2]):
            best = run
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return len(found), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest()


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run contains after its first period."""
    if not found:
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        steps[start + period] += 1
        steps[start + length] -= 1
    keep = np.cumsum(steps[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Identifiers and words of whole documents, so many as fill a block."""
    keys, texts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            data = (text.as_py() or "").encode()
            if keys and held + len(data) > BLOCK:
                yield keys, texts
                keys, texts, held = [], [], 0
            keys.append(key.as_py()), texts.append(data.split())
            held += len(data)
    if keys:
        yield keys, texts


def _rows(rewrite: Callable, result: Callable, schema: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _blocks(batches):
            texts = [rewrite(t, k) for t, k in zip(texts, keys, strict=True)]
            found = [(k, *row) for k, t, r in zip(keys, texts, runs(texts), strict=True) for row in result(t, r)]
            if found:
                columns = zip(zip(*found, strict=True), schema, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=schema)

    return rows


def _as_is(words: list[bytes], key) -> list[bytes]:
    return words


def find_runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, start, length, period`` of every run of every text, and the ``words`` of its first period."""
    schema = pa.schema([("key", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("words", pa.string())])

    def listed(words: list[bytes], found: list) -> list[tuple]:
        return [(s, n, q, b" ".join(words[s : s + q]).decode()) for s, n, q in found]

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    found = rows.mapInArrow(_rows(_as_is, listed, schema), "key string, start bigint, length bigint, period bigint, words string")
    return found.withColumn("key", F.col("key").cast(docs.schema[key].dataType))


def run_report(docs: DataFrame) -> DataFrame:
    """A row for each document: its runs counted and hashed, the one with the greatest exponent, the text without repetition."""
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    schema = pa.schema(list(zip((c.split()[0] for c in REPORT.split(", ")), kinds, strict=True)))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_rows(planted, lambda words, found: [_summary(words, found)], schema), REPORT)
