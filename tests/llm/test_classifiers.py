"""Language identification, quality and URL filters."""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewise.llm import language_id, quality, url_filter

SF = "/root/testdata/sf0.01"


def crc(key):
    return zlib.crc32(("" if key is None else str(key)).encode())


# language identification


def plain_vector(text):
    """The bundle of a text, n-gram by n-gram."""
    letters = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in f" {text} ".lower()))
    total = np.zeros(language_id.DIMENSIONS)
    for i in range(len(letters) - 2):
        gram = np.ones(language_id.DIMENSIONS)
        for place, letter in enumerate(letters[i : i + 3]):
            gram *= np.roll(language_id._letter(ord(letter)), place)
        total += gram
    return total / np.linalg.norm(total)


@pytest.mark.parametrize("block", [5, 1 << 20])
def test_vectors_bind_and_bundle(block, monkeypatch):
    monkeypatch.setattr(language_id, "BLOCK", block)
    texts = ["Ab, cd!", "x", "Éa ça 12 là", "漢字 かな", "the the the"]
    assert np.allclose(language_id.vectors(texts), [plain_vector(t) for t in texts], atol=1e-5)
    assert not language_id.vectors([None, "", "12 ?"]).any()


def test_a_small_table_of_ngrams_gives_the_same(monkeypatch):
    texts = ["some words in here", "Éa ça là", "漢字 かな und so weiter"]
    whole = language_id.vectors(texts)
    monkeypatch.setattr(language_id, "TABLE_ROWS", 16)
    language_id._table.cache_clear()
    assert np.allclose(language_id.vectors(texts), whole, atol=1e-6)
    language_id._table.cache_clear()


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.language_report(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    out = [r.lang == r.lang_pred for r in got if r.held_out and r.n_chars > 20]
    assert len(out) > 150 and np.mean(out) > 0.97


def test_language_of_every_document(spark):
    """The whole result by plain sums: prototypes of the documents not held out, the nearest of them to each text."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    plain = {r.doc_id: plain_vector(r.text) for r in rows if any(c.isalpha() for c in r.text or "")}
    sums = {}
    for r in rows:
        if r.lang is not None and r.doc_id in plain and crc(r.doc_id) % 4 != 2:
            sums[r.lang] = sums.get(r.lang, 0) + plain[r.doc_id]
    names = sorted(sums)
    prototypes = np.stack([sums[n] / np.linalg.norm(sums[n]) for n in names])
    got = language_id.language_report(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in rows)
    for r in got:
        assert r.held_out == (crc(r.doc_id) % 4 == 2)
        if r.doc_id not in plain:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosine = prototypes @ plain[r.doc_id]
        assert cosine[names.index(r.lang_pred)] >= cosine.max() - 1e-5 and r.score == pytest.approx(max(0.0, cosine.max()), abs=2e-5)


def test_language_of_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, score string"
    rows = [(i, t, g, "x") for i, (t, g) in enumerate([("der die das und", "de"), ("the of and to", "en")] * 8)]
    rows += [(100, None, "en", "x"), (101, "", "en", "x"), (102, "12 !", "de", "x"), (None, "the of", None, "x"), (103, "the " * 400_000, None, "x")]
    got = language_id.language_report(spark.createDataFrame(rows, schema)).collect()
    by_key = {r.doc_id: (r.lang_pred, r.score > 0) for r in got}
    assert by_key[100] == by_key[101] == by_key[102] == ("und", False) and by_key[None] == by_key[103] == ("en", True)
    unknown = spark.createDataFrame([(1, "a b", None, "x")], schema)
    assert language_id.language_report(unknown).first().lang_pred == "und"
    assert language_id.language_report(unknown.limit(0)).count() == 0


# quality


def test_any_number_of_languages(spark, monkeypatch):
    """Languages learned a few at a time give the verdicts of all at once."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(9000 + i, t, f"z{i}") for i, t in enumerate(("xq zq wq " * 9, None, "12 34", "kk jj hh"))], docs.schema)
    docs = docs.unionByName(odd)
    whole = sorted(map(tuple, language_id.language_report(docs).collect()))
    for group in (1, 3):
        monkeypatch.setattr(language_id, "GROUP_LANGUAGES", group)
        assert sorted(map(tuple, language_id.language_report(docs).collect())) == whole


def test_rules_are_read_from_printed_trees():
    text = """RandomForestClassificationModel
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 1 <= -2.0E-4)
      Predict: 0.0
     Else (feature 1 > -2.0E-4)
      Predict: 1.0
    Else (feature 0 > 1.5)
     If (feature 0 <= 3.0)
      Predict: 0.0
     Else (feature 0 > 3.0)
      Predict: 1.0
"""
    found = [r.bounds for r in quality.paths(text, ["a", "b"])]
    assert found == [
        (("a", True, 1.5),), (("a", True, 1.5), ("b", True, -2e-4)), (("a", True, 1.5), ("b", False, -2e-4)),
        (("a", False, 1.5),), (("a", False, 1.5), ("a", True, 3.0)), (("a", False, 3.0),),
    ]


def test_compiled_rules_are_the_weighted_sum(spark):
    model = quality.RuleEnsemble(0.5, ((quality.Rule((("a", True, 1.0), ("b", False, 2.0))), -3.0), (quality.Rule((("a", False, 0.0),)), 1.25)))
    rows = [(x, y) for x in (-1.0, 0.5, 1.0, 2.0) for y in (1.0, 2.0, 3.0)]
    got = spark.createDataFrame(rows, "a double, b double").select("a", "b", model.score().alias("s")).collect()
    for a, b, s in got:
        assert s == pytest.approx(1 / (1 + math.exp(-(0.5 - 3.0 * (a <= 1 and b > 2) + 1.25 * (a > 0)))))


def test_quality_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    report = quality.quality_report(docs, labels).cache()
    assert report.count() == docs.count()
    got = report.join(labels, "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == r.quality for r in got if r.held_out]) > 0.95
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == report.where("predicted = 1").count()


def plain_statistics(text):
    text = text or ""
    words, chars = re.findall(r"[^\x20\x09-\x0D]+", text), len(text)

    def share(part, of):
        return part / of if of else 0.0

    return {
        "words": len(words),
        "word_length": share(chars, len(words)),
        "distinct_words": share(len(set(re.split(r"[\x20\x09-\x0D]+", text.lower()))), len(words)),
        "upper": share(sum(unicodedata.category(c) == "Lu" for c in text), chars),
        "digits": share(sum(c in "0123456789" for c in text), chars),
        "stops": share(sum(c in ".,;:" for c in text), len(words)),
        "loud": share(sum(c in "!?" for c in text), len(words)),
        "symbols": share(sum(c in "#$%&*+=<>@^~_\\{}[]" for c in text), len(words)),
        "bars": share(sum(c in "|/" for c in text), len(words)),
        "lines": share(text.count("\n"), len(words)),
    }


def test_quality_of_every_document(spark):
    """The whole result by adding up the learned rules text by text; labels of held-out documents change nothing."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs.select("doc_id", "text"), labels)
    assert model.rules
    texts = dict(docs.select("doc_id", "text").collect())
    turned = F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    got = quality.quality_report(docs, labels.withColumn("quality", turned)).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        found, total = plain_statistics(texts[r.doc_id]), model.intercept
        for rule, weight in model.rules:
            total += weight * all(found[n] <= v if upper else found[n] > v for n, upper, v in rule.bounds)
        score = 1 / (1 + math.exp(-total))
        assert r.held_out == (crc(r.doc_id) % 5 == 0) and r.score == pytest.approx(score, abs=1e-9) and r.predicted == (r.score >= 0.3)


def test_quality_of_odd_rows(spark):
    schema = "doc_id bigint, text string, words string, score string"
    docs = spark.createDataFrame([(1, None, "x", "y"), (1, "", "x", "y"), (None, "some text", "x", "y"), (2, "w! " * 100_000, "x", "y")], schema)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality.quality_report(docs, none).collect()
    assert len(got) == 4 and all(r.predicted == 1 and 0 <= r.score <= 1 for r in got)
    bad = spark.createDataFrame([(1, 0, 0), (2, 0, 0), (2, None, 0), (None, 1, 0)], none.schema)
    assert quality.keep_good(docs, bad).count() == 0
    assert quality.quality_report(docs.limit(0), bad).count() == 0


# url filters


def plain_parts(url):
    found = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?", url or "")
    if not found:
        return "", "", ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in found[1])
    return host, found[2], found[3] or ""


def plain_rule(host, path):
    fitting = []
    for verdict, rule in url_filter.GIVEN:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fitting.append((len(rule), rule, verdict))
    return max(fitting)[1:] if fitting else (None, None)


def plain_tokens(url):
    host, path, query = plain_parts(url)
    found = {f"h:{x}" for x in host.split(".")} | {f"p:{x}" for x in re.split("[/._-]+", path.lower()) if not re.fullmatch("[0-9]*", x)}
    found |= {f"q:{x}" for x in re.findall("[?&]([^=&]+)", query)}
    return frozenset(t for t in found if len(t) > 2)


def plain_verdicts(urls, toxic, support=0.01, confidence=0.9):
    """Verdicts with every combination of tokens counted."""
    known, counts = [], {}
    for url, mark in zip(urls, toxic, strict=True):
        verdict = plain_rule(*plain_parts(url)[:2])[1] or {True: "block", False: "allow"}.get(mark)
        if verdict:
            known.append((plain_tokens(url), verdict))
    for tokens, verdict in known:
        for n in range(1, len(tokens) + 1):
            for some in itertools.combinations(sorted(tokens), n):
                both = counts.setdefault(some, [0, 0])
                both[0] += 1
                both[1] += verdict == "block"
    least = math.ceil(support * len(known))
    rules = [set(c) for c, (n, b) in counts.items() if b >= least and b / n >= confidence]
    out = []
    for url in urls:
        rule, verdict = plain_rule(*plain_parts(url)[:2])
        hit = any(r <= plain_tokens(url) for r in rules)
        out.append((*plain_parts(url)[:2], rule, verdict or ("block" if hit else "allow"), hit))
    return out


def test_hosts_paths_and_given_rules(spark):
    urls = [
        None, "", "no scheme.com/x", "http://Example.COM/en/a?x#y", "https://www.example.com/en/1", "x://a.www.example.com/en/", "http://com/", "http://a.com",
        "http://notexample.com/en/", "http://b.net/es/1", "http://b.net/fr", "http://b.net/FR/", "a://b://c.net/fr/", "http://É.net/es/?q=://", "http://x.org#://com/",
    ]
    frame = spark.createDataFrame([(i, u, "c", "d") for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judge_pages(frame, labels).collect()}
    assert got == {i: (*plain_parts(u)[:2], plain_rule(*plain_parts(u)[:2])[0]) for i, u in enumerate(urls)}
    assert url_filter.judge_pages(frame.limit(0), labels).count() == 0


def test_mined_rules_agree_with_counting_all_combinations(spark):
    pages, labels = spark.read.parquet(f"{SF}/pages.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = pages.select("page_id", "url", url_filter.document_of(F.col("url")).alias("doc_id")).collect()
    toxic = {r.doc_id: r.toxic == 1 for r in labels.collect()}
    expected = plain_verdicts([r.url for r in rows], [toxic.get(r.doc_id) for r in rows])
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.mined) for r in url_filter.judge_pages(pages, labels).collect()}
    assert got == {r.page_id: e for r, e in zip(rows, expected, strict=True)}
    assert any(e[4] for e in expected)


def test_mined_rules_reach_pages_no_given_rule_fits(spark):
    urls = [f"http://{h}.example.org/{lang}/{i}" for i in range(60) for h, lang in (("bad", "xx"), ("bad", "en"), ("good", "xx"))]
    toxic = [("bad" in u and "xx" in u) if i % 2 else None for i, u in enumerate(urls)]
    pages = spark.createDataFrame(list(enumerate(urls)), "key bigint, url string")
    marks = spark.createDataFrame([(i, t) for i, t in enumerate(toxic) if t is not None], "key bigint, block boolean")
    got = {r.key: r.verdict for r in url_filter.judge(pages, marks, rules=()).collect()}
    assert got == {i: "block" if "bad" in u and "xx" in u else "allow" for i, u in enumerate(urls)}


def test_bad_host_below_a_hundredth_of_the_pages_is_blocked(spark):
    urls = [f"http://bad.example.org/en/{i}" for i in range(10)] + [f"http://good{i % 9}.example.org/en/{i}" for i in range(90)]
    urls += [f"http://few.example.org/en/{i}" for i in range(4)] + [f"http://a{i % 7}.com/en/{i}" for i in range(1500)]
    pages = spark.createDataFrame(list(enumerate(urls)), "key bigint, url string")
    marks = [(i, "bad" in u or "few" in u) for i, u in enumerate(urls[:104]) if i not in range(6, 10)]
    got = {r.key: r.verdict for r in url_filter.judge(pages, spark.createDataFrame(marks, "key bigint, block boolean")).collect()}
    assert got == {i: "block" if "bad" in u else "allow" for i, u in enumerate(urls)}


def plain_rest(urls, toxic, confidence=0.9):
    """Urls that no given rule fits and a rule of such urls blocks, with every combination of tokens counted."""
    rest = [(u, mark) for u, mark in zip(urls, toxic, strict=True) if plain_rule(*plain_parts(u)[:2])[1] is None]
    known, counts = [(u, mark) for u, mark in rest if mark is not None], {}
    for url, mark in known:
        tokens, host = plain_tokens(url), plain_parts(url)[0]
        for some in [c for n in range(1, len(tokens) + 1) for c in itertools.combinations(sorted(tokens), n)] + [("=" + host,)] * bool(host) + [("=" + host, t) for t in tokens if host]:
            both = counts.setdefault(some, [0, 0])
            both[0] += 1
            both[1] += mark
    least = {True: 5, False: max(5, math.ceil(0.001 * len(known)))}
    rules = [set(c) for c, (n, b) in counts.items() if b >= least[len(c) == 1 or c[0][0] == "="] and b / n >= confidence]
    return {u for u, _ in rest if any(r <= plain_tokens(u) | {"=" + plain_parts(u)[0]} for r in rules)}


@pytest.mark.parametrize("n", [3, 60, 6000])
def test_rules_of_undecided_pages_agree_with_counting(spark, n):
    rng = np.random.default_rng(n)
    urls, toxic = [], []
    for i in range(n):
        host = "hot.org" if i % 3 == 0 else f"{'abc'[rng.integers(3)]}.s{int(rng.zipf(1.3)) % 40}.org"
        words = rng.choice(["win", "free", "news", "blog", "x"], 2)
        urls.append(f"http://{host}/{words[0]}/{words[1]}-{i}?k{rng.integers(3)}=1")
        bad = "a.s1." in host or ("b.s2." in host and "win" in words) or {"win", "free"} <= set(words) or "k2" in urls[-1] and "blog" in words and host == "hot.org"
        toxic.append(None if rng.random() < 0.2 else bool(bad) != (rng.random() < 0.02))
    pages = spark.createDataFrame(list(enumerate(urls)), "key bigint, url string")
    marks = spark.createDataFrame([(i, t) for i, t in enumerate(toxic) if t is not None], "key bigint, block boolean")
    whole = plain_verdicts(urls, toxic)
    rest = plain_rest(urls, toxic)
    got = {r.key: r.verdict for r in url_filter.judge(pages, marks).collect()}
    assert got == {i: "block" if w[3] == "block" or u in rest else "allow" for i, (u, w) in enumerate(zip(urls, whole, strict=True))}
    assert n < 1000 or len(rest) > n / 100
