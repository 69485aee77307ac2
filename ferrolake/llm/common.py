"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: Frees the shuffle files of an execution as soon as it ends: what was stored is read back from its table.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE)
        else:
            spark.conf.set(_FREE, before)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(spark, name)
    schema = df.schema
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(col: str | Column) -> Column:
    """An id usable as a join key: a null id stands for the smallest long."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(-(2**63)).cast("long"))


def ranked(spark: SparkSession, df: DataFrame, by: list[str], out: str, name: str) -> DataFrame:
    """``df`` plus ``out``, its dense 0-based position in the order of ``by``, without a one-task window.

    Rows are range-partitioned and sorted, stored, and each partition's start is the number of rows in the
    partitions before it (one row per partition goes through the only global window). ``by`` must tell all
    rows apart that need distinct, repeatable positions.
    """
    parts = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    kept = stored(spark, parts, name).withColumn("_part", F.shiftright("_at", 33))
    starts = kept.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = starts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))
    return (kept.join(F.broadcast(starts), "_part")  # one row per partition
            .withColumn(out, F.col("_start") + F.col("_at").bitwiseAND(F.lit(2**33 - 1)))
            .drop("_at", "_part", "_start"))
