"""From raw documents to token ids: the stages of a training corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again before the next stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnmill.llm import jaccard, mixing, pieces, quality, repeats
from turnmill.scratch import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules."""
    return quality.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand in earlier documents."""
    return repeats.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their shares to the power ``TEMPER`` by repeating documents; every
    document stays."""
    labelled = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixed(docs, labelled, domain="source", temper=mixing.TEMPER, least=1.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids."""
    return pieces.encoded(docs).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mixing", mix),
    ("token ids", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs


# The learnt classifier and the merges of a vocabulary are beyond SQL; the tests hold the
# stages against brute-force versions instead.
ORACLE_SQL = None
