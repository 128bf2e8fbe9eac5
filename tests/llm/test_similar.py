"""Near copies of the pipeline against brute-force similarities of word shingles."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from lapsewise.llm import similar, simhash
from lapsewise.sources.workspace import Scratch

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, `print` string, n int"


def plain_set(text):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_groups(texts):
    """The set of places each text is linked with, chains included."""
    sets, groups, seen = [plain_set(t) for t in texts], {}, set()
    for start in range(len(sets)):
        if start in seen:
            continue
        reached, front = {start}, [start]
        while front:
            a = sets[front.pop()]
            near = [i for i, b in enumerate(sets) if i not in reached and (a == b or 5 * len(a & b) >= 4 * len(a | b))]
            reached.update(near)
            front += near
        seen |= reached
        groups |= dict.fromkeys(reached, frozenset(reached))
    return groups


def changed(words, n, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"c{rng.randrange(10**6)}"
    return words


def made():
    """Copies on both sides of 0.8, chains, a dense group, short, empty and null texts, repeated and null ids."""
    rng, rows = random.Random(4), [(500, None), (501, ""), (502, " \n"), (503, "One two"), (504, "one  TWO"), (505, "one two three")]
    for group in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(60, 400))]
        for copy in range(4):
            rows.append((1000 + 10 * group + copy, " ".join(words)))
            words = changed(words, max(1, len(words) * rng.randrange(1, 5) // 100), rng)
    words = [f"d{i}" for i in range(200)]
    rows += [(2000 + i, " ".join(changed(words, rng.randrange(1, 5), rng))) for i in range(60)]
    return [*rows, (None, rows[10][1]), (1000, "a text of its own under a repeated id")]


def test_near_copies_agree_with_brute_force(spark):
    rows = [(i, t, "x", 1) for i, t in made()]
    groups, least = plain_groups([t for _, t, *_ in rows]), {}
    for at, (key, *_) in enumerate(rows):
        if key is not None:
            least[groups[at]] = min(key, least.get(groups[at], key))
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.without_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    text_group = {t: groups[at] for at, (_, t, *_) in enumerate(rows)}
    assert sorted((least[text_group[r.text]], r.doc_id) for r in kept.collect()) == sorted((x, x) for x in least.values())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    groups = plain_groups([t for _, t in rows])
    expected = sorted(min(rows[i][0] for i in group) for group in set(groups.values()))
    assert sorted(r.doc_id for r in similar.near_dedup(docs).collect()) == expected


def test_fingerprints_link_without_the_other_keys(spark):
    rng, rows = random.Random(21), []
    for group in range(12):
        words = [f"f{rng.randrange(10**6)}" for _ in range(900)]
        rows += [(10 * group, " ".join(words)), (10 * group + 1, " ".join(changed(words, 2, rng))), (10 * group + 2, " ".join(words).upper() + " end")]
    prints = {i: simhash.fingerprint(t) for i, t in rows}
    near = {i for i in prints if i % 10 and (prints[i] ^ prints[i - i % 10]).bit_count() <= 4}
    assert len(near) >= 12
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), similar.sketches("text").alias("s"), simhash.fingerprints("text").alias("fingerprint"))
    marked = marked.select("doc_id", "mark", "s.print", "s.n", F.array().cast("array<bigint>").alias("keys"), "fingerprint")
    classes = similar.classes(marked, docs.select(F.xxhash64("text").alias("mark"), "text"), Scratch(spark, "t"))
    found = {r.doc_id: r.component_id for r in marked.join(classes, "print").collect()}
    assert all(found[i] == i - i % 10 for i in near)
    assert all(found[i] // 10 == i // 10 for i in found)


def star(copies, rng):
    """Copies of one text, each like it but hardly like one another."""
    words = [f"s{i}" for i in range(200)]
    rows = [(1, " ".join(words))]
    for i in range(copies):
        changed_words = list(words)
        for at in rng.sample(range(4, 196, 5), 4):
            changed_words[at] = f"n{i}x{at}"
        rows.append((2 + i, " ".join(changed_words)))
    return rows


def test_star_of_copies_in_small_blocks(spark, monkeypatch):
    rows = star(150, random.Random(8))
    rows += [(5000 + i, t.replace("s19", "q")) for i, t in rows]
    groups = plain_groups([t for _, t in rows])
    expected = sorted(min(rows[i][0] for i in group) for group in set(groups.values()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in similar.near_dedup(docs).collect()) == expected
    monkeypatch.setattr(similar.classes, "__defaults__", (2000,))
    assert sorted(r.doc_id for r in similar.near_dedup(docs).collect()) == expected


def test_spanning_links_join_what_all_pairs_join():
    rng = random.Random(11)
    for _ in range(30):
        words = [f"w{i}" for i in range(100)]
        texts = [" ".join(changed(words, rng.randrange(0, 9), rng)) for _ in range(25)]
        sets = [similar.shingle_set(t) for t in texts]
        groups = np.array([str(i // 2) if i < 6 else str(i) for i in range(25)], object).astype(str)
        links = similar.spanning_links([str(i) for i in range(25)], groups, np.array([len(s) for s in sets]), np.concatenate(sets))
        assert all(similar.similar(sets[int(u)], sets[int(v)]) for u, v in links)

        def joined(pairs):
            root = list(range(25))

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x

            for a, b in pairs:
                root[find(a)] = find(b)
            return sorted(sorted(i for i in range(25) if find(i) == r) for r in {find(i) for i in range(25)})

        known = [(0, 1), (2, 3), (4, 5)]
        every = [(i, j) for i in range(25) for j in range(i) if similar.similar(sets[i], sets[j])]
        assert joined(known + [(int(u), int(v)) for u, v in links]) == joined(known + every)
