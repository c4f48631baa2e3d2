"""The corpus pipeline: language, boilerplate, near duplicates, secrets, packing.

Each stage works on all documents its predecessor kept and has effect: rejected
and near-duplicate documents go, boilerplate lines and secrets leave the texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import langid, lines, minhash, packing, secrets
from cohortlens.llm.common import stored
from cohortlens.llm.queries import held_out, vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.keep_identified(docs, langid.fit(docs, ~held_out(3, 1)))


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand on many sites."""
    return lines.remove_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return minhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets masked."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in training sequences."""
    return packing.pack(docs, vocabulary_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language), ("line_dedup", boilerplate), ("minhash_near_dedup", near_duplicates),
    ("secret_scan", secret_scan), ("packing", pack)]

#: The fitted models and the tokenizer cannot be expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
