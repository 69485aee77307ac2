"""Reference/lookup CSV seeds, read with an explicit schema and written as a full overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load_seed(spark: SparkSession, csv_path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(csv_path)


def write_seed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
