"""One named query per corpus operator, over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapsewise.llm import (
    bpe, exact_dedup, language_id, mixing, negatives, neighbours, periodic, piecewise, quality, repeats, simhash, token_store, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dup_report(table(spark, sf_dir, "documents"))


@query
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_report(table(spark, sf_dir, "documents"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_report(table(spark, sf_dir, "documents"))


ORACLES["op6_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


@query
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbour_report(table(spark, sf_dir, "embeddings"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(table(spark, sf_dir, "documents"))


ORACLES["op8_mixing"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS n,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM d GROUP BY source
), level AS (
  SELECT 0 AS step, sum(n) * 1.5::DOUBLE / sum(w) AS l FROM s
  UNION ALL
  SELECT step + 1, (SELECT (sum(n) * 1.5::DOUBLE - coalesce(sum(2 * n) FILTER (2 * n < l * w), 0))
                    / sum(w) FILTER (NOT 2 * n < l * w) FROM s)
  FROM level WHERE step < (SELECT count(*) FROM s)
), t AS (
  SELECT source, n, least(2.0::DOUBLE * n, (SELECT max_by(l, step) FROM level) * w) AS target FROM s
), r AS (
  SELECT doc_id, size, n, target, CASE WHEN n > 0 THEN target / n ELSE 0 END AS rate,
         ('0x' || substr(md5('8:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, n AS source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""


@query
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_report(table(spark, sf_dir, "documents"))


@query
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(table(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.negative_report(table(spark, sf_dir, "embeddings"))


@query
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise.fingerprint_report(table(spark, sf_dir, "documents"))


@query
def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(table(spark, sf_dir, "documents"))
