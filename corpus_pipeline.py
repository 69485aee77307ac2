"""The training-data pipeline: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrolake.llm import exact_dedup, mixing, near_dedup, quality, sentencepieces
from ferrolake.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled ones among its input."""
    return quality.keep_good(docs, docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.near_dedup(spark, docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row that the mix takes, as often as it takes it."""
    return mixing.mixed(spark, docs).drop("__shard", "__order")


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row: doc_id, n_pieces, pieces, round_trip. Rows that the mix repeats are numbered (they
    are equal, so any order will do) and cut differently."""
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    return sentencepieces.encode(docs, copy=F.row_number().over(same) - 1)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: Sampling, trained models and tokenizers can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(spark, docs, f"pipeline-{name}")
    return docs
