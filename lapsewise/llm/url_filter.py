"""URL filtering: given host and path rules first, mined association rules for the rest.

A url is cut into tokens (labels of the host, words of the path, keys of the query). Spark's
FP-growth mines token combinations that go with the label ``block`` among labelled urls; rules
pruned by support and confidence, and by shorter rules that say the same, are looked up through
an inverted index that lists each rule under its rarest token. Only distinct token sets are
matched, so a host with a third of all pages costs as much as its distinct paths.

Labelled pages that no given rule fits are mined once more by themselves, as the decided ones would outweigh
them: every token, every whole host, and every host with one more token are counted by aggregation, and
go with block from ``MIN_PAGES`` blocked pages, whatever share of the table these are; FP-growth mines other
combinations from ``REST_SUPPORT`` and as many blocked pages (with so few pages it would bring every host to
the driver). All are matched by the inverted index; these rules are for pages that no given rule fits.

Everything is DataFrame work in the JVM. What FP-growth brings to the driver are frequent single
tokens: at most (tokens per url) / ``min_support`` of them. Rules are bounded alike.

Defined cases: a null url, or one without ``://``, has empty host and path, no tokens, fits no rule
and is allowed; without any labelled url, or without blocks among them, nothing is mined and what
fits no given rule is allowed; repeated rows are judged alike; an empty table gives an empty result;
other columns do not matter, as results are built from the key and the url alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from lapsewise.sources.workspace import Scratch

#: fixed values: the given rules, as (verdict, rule)
GIVEN = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
REST_SUPPORT, MIN_PAGES = 0.001, 5
BLOCK, ALLOW = "=block", "=allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, group), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(_part(url, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return _part(url, 2)


def given_rule(host_: Column, path_: Column, rules: Sequence[tuple[str, str]] = GIVEN) -> tuple[Column, Column]:
    """The longest given rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((host_ == name) | host_.endswith(f".{name}")) & path_.startswith(f"/{rest}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Sorted distinct tokens: ``h:`` host labels, ``p:`` path words that are no numbers, ``q:`` query keys."""
    labels = F.transform(F.split(host(url), r"\."), lambda x: F.concat(F.lit("h:"), x))
    words = F.filter(F.split(F.lower(path(url)), r"[/._-]+"), lambda x: ~x.rlike(r"^[0-9]*$"))
    keys = F.transform(F.regexp_extract_all(_part(url, 3), F.lit(r"[?&]([^=&]+)"), 1), lambda x: F.concat(F.lit("q:"), x))
    found = F.concat(labels, F.transform(words, lambda x: F.concat(F.lit("p:"), x)), keys)
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: F.length(x) > 2)))


def mine_rules(
    labelled: DataFrame, scratch: Scratch, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """``antecedent, token, confidence, support`` from ``tokens, label``; ``token`` is the rarest of the antecedent."""
    items = scratch.store(labelled.select(F.array_append("tokens", F.col("label")).alias("items")), "transactions")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent")[0] == BLOCK).where(~F.array_contains("antecedent", ALLOW))
    rules = scratch.store(
        rules.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"), "mined"
    )
    shorter = rules.select(F.col("antecedent").alias("part"), F.explode("antecedent").alias("token"))
    implied = rules.select("antecedent", F.explode("antecedent").alias("token")).join(shorter, "token")
    covers = (F.size("part") < F.size("antecedent")) & (F.size(F.array_except("part", "antecedent")) == 0)
    kept = rules.join(implied.where(covers).select("antecedent").distinct(), "antecedent", "left_anti")
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = kept.select("antecedent", F.explode("antecedent").alias("token")).join(single, "token")
    rarest = rarest.groupBy("antecedent").agg(F.min(F.struct("freq", "token"))["token"].alias("token"))
    return scratch.store(kept.join(rarest, "antecedent"), "rules")


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``tokens`` of ``sets`` that contain the antecedent of some rule."""
    posted = sets.select("tokens", F.explode("tokens").alias("token"))
    found = posted.join(rules.select("token", "antecedent"), "token")
    return found.where(F.size(F.array_except("antecedent", "tokens")) == 0).select("tokens").distinct()


def with_host(tokens_: Column, host_: Column) -> Column:
    """The tokens, and the whole host as one more token ``=host``."""
    return F.when(host_ == "", tokens_).otherwise(F.array_append(tokens_, F.concat(F.lit("="), host_)))


def candidates(tokens_: Column, host_: Column) -> Column:
    """Each token, the whole host, and the host with each token."""
    whole = F.concat(F.lit("="), host_)
    single = F.transform(tokens_, lambda x: F.array(x))
    both = F.transform(tokens_, lambda x: F.array(whole, x))
    return F.when(host_ == "", single).otherwise(F.concat(single, F.array(F.array(whole)), both))


def count_rules(labelled: DataFrame, scratch: Scratch, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``antecedent, token`` of the candidates that go with block from ``MIN_PAGES`` blocked pages, whatever share these are.

    ``token`` is the rarer of the antecedent. Two tokens one of which is a rule of its own are left out.
    """
    antecedent = F.explode(candidates(F.col("tokens"), F.col("host"))).alias("antecedent")
    counts = labelled.select(antecedent, (F.col("label") == BLOCK).alias("block")).groupBy("antecedent")
    counts = counts.agg(F.count(F.lit(1)).alias("n"), F.count_if("block").alias("blocked")).where(F.col("blocked") >= MIN_PAGES)
    counts = scratch.store(counts, "counts")
    rule = F.col("blocked") >= F.col("n") * min_confidence
    single = counts.where(F.size("antecedent") == 1).select(F.col("antecedent")[0].alias("token"), F.col("n").alias("freq"), rule.alias("alone"))
    parts = counts.where(rule).select("antecedent", F.explode("antecedent").alias("token")).join(single, "token")
    # both tokens of a frequent pair are frequent, so none is missing here
    parts = parts.groupBy("antecedent").agg(F.bool_or("alone").alias("alone"), F.min(F.struct("freq", "token"))["token"].alias("token"))
    return scratch.store(parts.where((F.size("antecedent") == 1) | ~F.col("alone")).select("antecedent", "token"), "simple")


def match_rest(known: DataFrame, scratch: Scratch, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """The distinct ``tokens, host`` that a rule from labelled pages without given rule fits, of pages without one."""
    rest = scratch.store(known.where("says IS NULL").select("tokens", "host", "label"), "rest")
    labelled = rest.where("label IS NOT NULL")
    n = max(labelled.count(), 1)
    least = max(REST_SUPPORT, (MIN_PAGES - 0.5) / n)  # half a page less: FP-growth rounds the count up
    mined = mine_rules(labelled, scratch, min(1.0, least), min_confidence).where(F.col("support") * n > MIN_PAGES - 0.5)
    rules = mined.select("antecedent", "token").unionByName(count_rules(labelled, scratch, min_confidence))
    sets = rest.select("tokens", "host").distinct().withColumn("all", with_host(F.col("tokens"), F.col("host")))
    fits = match_rules(sets.select(F.col("all").alias("tokens")), scratch.store(rules.distinct(), "rest_rules"))
    found = sets.join(fits.withColumnRenamed("tokens", "all"), "all", "left_semi")
    return scratch.store(found.select("tokens", "host"), "found")


def judge(
    urls: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = GIVEN,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """``key, host, path, rule, verdict, mined`` for every row of ``urls`` (``key, url``).

    A url is labelled by the given rule that fits it, else by ``labels`` (``key, block``). The verdict
    is the given rule's, else block where a mined rule matches, else allow.
    """
    scratch = Scratch(urls.sparkSession, "urls")
    url = F.col("url")
    rule, says = given_rule(F.col("host"), F.col("path"), rules)
    parts = urls.select("key", host(url).alias("host"), path(url).alias("path"), tokens(url).alias("tokens"))
    parts = scratch.store(parts.withColumns({"rule": rule, "says": says}), "parts")
    marks = labels.groupBy("key").agg(F.max(F.col("block").cast("int")).alias("mark"))
    known = parts.join(marks, "key", "left").withColumn(
        "label",
        F.when(F.col("says") == "block", BLOCK).when(F.col("says") == "allow", ALLOW).when(F.col("mark") == 1, BLOCK).when(F.col("mark") == 0, ALLOW),
    )
    mined = mine_rules(known.where("label IS NOT NULL"), scratch, min_support, min_confidence)
    blocked = match_rules(parts.select("tokens").distinct(), mined).withColumn("hit", F.lit(True))
    judged = parts.join(scratch.store(blocked, "blocked"), "tokens", "left")
    rest = match_rest(known, Scratch(urls.sparkSession, "urls-rest"), min_confidence).withColumn("rest", F.lit(True))
    judged = judged.join(rest, ["tokens", "host"], "left")
    hit = F.coalesce("hit", F.col("says").isNull() & F.col("rest"), F.lit(False))
    verdict = F.coalesce("says", F.when(hit, "block").otherwise("allow"))
    return judged.select("key", "host", "path", "rule", verdict.alias("verdict"), hit.alias("mined"))


def document_of(url: Column) -> Column:
    """The document a page was made from: the number after the language in the path; null without one."""
    return F.nullif(F.regexp_extract(path(url), r"^/[^/]*/([0-9]{1,18})", 1), F.lit("")).try_cast("bigint")


def judge_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Every page's verdict. Besides the given rules, a page is labelled through its document: block where toxic."""
    named = pages.select("page_id", "url", document_of(F.col("url")).alias("doc_id"))
    marks = labels.groupBy("doc_id").agg((F.max("toxic") == 1).alias("block")).where("block IS NOT NULL")
    marks = named.where("doc_id IS NOT NULL").join(marks, "doc_id").select(F.col("page_id").alias("key"), "block")
    judged = judge(pages.select(F.col("page_id").alias("key"), "url"), marks)
    return judged.withColumnRenamed("key", "page_id")
