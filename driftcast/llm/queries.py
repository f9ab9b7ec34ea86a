"""Registered queries of the text operators: {name: (query, SQL or None)}.

Each runs over its whole table. Where SQL can't express the method, the SQL is
None and the query is tested against a brute-force version (tests/llm).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcast.llm import (
    bpe, exact_dedup, html_extract, langid, licences, maxent_lm, near_dedup, packing, quality, token_counts)
from driftcast.llm.common import held_out
from driftcast.llm.queries_groups import QUERIES as GROUPS


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
  FROM documents)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256
FROM (SELECT *, first_value(doc_id) OVER (PARTITION BY plain ORDER BY chars DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY plain) AS group_size FROM n)
"""


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score(documents(spark, sf_dir), held_out("doc_id", 7, 2))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


# Brute force over the inverted index of distinct sets, then reachability.
OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 2),
                                                lambda i: array_to_string(words[i:i + 3], ' ')))) END AS shingles
  FROM w),
reps AS (SELECT shingles, min(doc_id) AS rep, len(shingles) AS n FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
items AS (SELECT rep, n, unnest(shingles) AS shingle FROM reps),
common AS (
  SELECT a.rep AS a, b.rep AS b, a.n + b.n AS n, count(*) AS c
  FROM items a JOIN items b ON a.shingle = b.shingle AND a.rep < b.rep
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT rep AS v, rep AS r FROM reps
  UNION
  SELECT reach.v, edges.b FROM reach JOIN edges ON reach.r = edges.a),
component AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v)
SELECT s.doc_id, len(s.shingles) AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(c.component_id, s.doc_id) AS kept
FROM sets s LEFT JOIN reps r ON s.shingles = r.shingles LEFT JOIN component c ON c.v = r.rep
"""


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = held_out("doc_id", 4, 2)
    return langid.identify(docs, ~out).withColumn("held_out", out)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir))


QUERIES = {
    "op1_exact_dedup": (op1_exact_dedup, OP1_SQL),
    "op2_quality_rules": (op2_quality_rules, None),
    "op3_html_extraction": (op3_html_extraction, None),
    "op4_lm_scoring": (op4_lm_scoring, None),
    "op5_token_counts": (op5_token_counts, None),
    "op6_license_scan": (op6_license_scan, None),
    "op7_minhash_near_dedup": (op7_minhash_near_dedup, OP7_SQL),
    "op8_best_fit_packing": (op8_best_fit_packing, None),
    "op9_language_id": (op9_language_id, None),
    "op10_bpe": (op10_bpe, None),
} | GROUPS
