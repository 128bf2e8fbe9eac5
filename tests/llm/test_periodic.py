"""Runs of words against all periods tried one by one."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from lapsewise.llm import periodic

SCHEMA = "doc_id bigint, text string, start string, words int"


def plain_runs(words):
    """``start, length, period`` of every run, by trying each period at each place."""
    least, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                least.setdefault((i, j + q), q)
            i = j
    return sorted(((s, e - s, q) for (s, e), q in least.items()), key=lambda r: (r[0], r[2]))


def plain_report(rows):
    out = []
    for key, text in rows:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(key).encode())
        if key is not None and n and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = plain_runs(words)
        dropped = {i for s, length, q in found for i in range(s + q, s + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in found).encode()
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        out.append((key, len(found), *top, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(rng):
    """Words with repeats of repeats, cut and joined."""
    words = []
    for _ in range(rng.randrange(0, 8)):
        kind = rng.randrange(4)
        if kind == 0:
            words += [rng.choice("ab") for _ in range(rng.randrange(1, 60))]
        elif kind == 1:
            unit = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 15))]
            words += (unit * 30)[: rng.randrange(1, 8 * len(unit) + 30)]
        elif kind == 2:
            words += words[-rng.randrange(1, 40) :] * rng.randrange(1, 5)
        else:
            words += [f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 80))]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_all_periods(seed):
    rng = random.Random(seed)
    for _ in range(100):
        texts = [[w.encode() for w in made(rng)] for _ in range(rng.randrange(1, 6))]
        texts.append(list(texts[0]))
        assert periodic.runs(texts) == [plain_runs(t) for t in texts]


def test_grammar_spells_the_words():
    rng = random.Random(9)
    texts = [made(rng) for _ in range(40)]
    ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    words = np.array([ids[w] for t in texts for w in t])
    documents = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    grammar = periodic.Grammar(words.copy(), documents)

    def spell(symbol):
        return [symbol] if symbol < grammar.terminals else spell(grammar.left[symbol]) + spell(grammar.right[symbol])

    assert [w for root in grammar.roots for w in spell(root)] == words.tolist()
    assert len(grammar.roots) == sum(map(bool, texts)) and grammar.size < 2 * len(words)
    for symbol in range(grammar.terminals, grammar.size):
        first = grammar.first[symbol]
        assert words[first : first + grammar.length[symbol]].tolist() == spell(symbol)


def test_colliding_hashes_do_not_decide(monkeypatch):
    rng = random.Random(6)
    texts = [[w.encode() for w in made(rng)] for _ in range(5)]
    expected, whole, seeds = [plain_runs(t) for t in texts], periodic._Reach.same, []

    def careless(self, i, q, n):
        return np.ones(len(i), bool) if self.blind else whole(self, i, q, n)

    begin = periodic._Reach.__init__

    def blind_once(self, words, seed):
        begin(self, words, seed)
        self.blind = seed == 0
        seeds.append(seed)

    monkeypatch.setattr(periodic._Reach, "__init__", blind_once)
    monkeypatch.setattr(periodic._Reach, "same", careless)
    assert periodic.runs(texts) == expected and 1 in seeds


def test_fibonacci_and_one_word():
    a, b = [b"x"], [b"x", b"y"]
    while len(b) < 3000:
        a, b = b, b + a
    assert periodic.runs([b, [b"z"] * 5000]) == [plain_runs(b), [(0, 5000, 1)]]


def test_report(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(made(rng))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (None, "a b " * 40), (3, "a b " * 40), (3, "a b " * 40), (-1, "one"), (203, "word " * 50_000)]
    rows += [(k, " ".join(f"u{i}" for i in range(60))) for k in range(300, 340)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert sorted(map(tuple, periodic.run_report(docs).collect()), key=str) == plain_report(rows)
    assert periodic.run_report(docs.limit(0)).count() == 0


def test_runs_as_rows(spark):
    docs = spark.createDataFrame([("x", "to be or " * 10 + "not"), ("y", "nothing here")], "doc_id string, text string")
    assert [tuple(r) for r in periodic.find_runs(docs).collect()] == [("x", 0, 30, 3, "to be or")]
