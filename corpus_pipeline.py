"""The corpus pipeline: quality rules, language ID, exact dedup, MinHash
near-dedup, best-fit packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftcast.llm import exact_dedup, langid, near_dedup, packing, quality
from driftcast.llm.common import held_out, staged
from driftcast.session import apply_conf, ensure_checkpoint_dir


def _ready(spark: SparkSession) -> None:
    apply_conf(spark)
    ensure_checkpoint_dir(spark)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (operator 2)."""
    _ready(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one learned language holds at least half (operator 9)."""
    _ready(spark)
    return langid.keep_identified(docs, ~held_out("doc_id", 4, 2))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (operator 1)."""
    _ready(spark)
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 7; shingles of
    five words, similarity 0.8 or more)."""
    _ready(spark)
    return near_dedup.drop_near_copies(docs, shingle=5)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences (operator 8)."""
    _ready(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    _ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


# The quality, language and near-copy decisions are beyond SQL.
ORACLE_SQL = None
