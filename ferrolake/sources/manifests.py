"""Run manifests (JSON documents describing models, columns and dependencies) read as DataFrames.

A manifest is ``{"metadata": {"invocation_id": ...}, "nodes": {"<unique_id>": {resource_type, name, schema, database,
depends_on: {nodes: [...]}, columns: {<name>: {description, data_type}}, tags: [...],
description}}}``. Many projects x runs are read in parallel: one manifest per file (``wholetext``)
or one per line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMN_SCHEMA = T.StructType([T.StructField("description", T.StringType()),
                              T.StructField("data_type", T.StringType())])
NODE_SCHEMA = T.StructType([
    T.StructField("resource_type", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("database", T.StringType()),
    T.StructField("depends_on", T.StructType([T.StructField("nodes", T.ArrayType(T.StringType()))])),
    T.StructField("columns", T.MapType(T.StringType(), COLUMN_SCHEMA)),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("description", T.StringType()),
])
MANIFEST_SCHEMA = T.StructType([T.StructField("metadata", T.StructType([T.StructField("invocation_id", T.StringType())])),
                                T.StructField("nodes", T.MapType(T.StringType(), NODE_SCHEMA))])


def read_manifests(spark: SparkSession, path: str, one_per_file: bool = True, without: Sequence[str] = ()) -> DataFrame:
    """``(run_id, nodes)``: one row per manifest; a run is named by its invocation id, else by its file. ``without``: fields
    of a node that the caller does not use; they are skipped, not turned into values."""
    node = T.StructType([f for f in NODE_SCHEMA.fields if f.name not in without])
    schema = T.StructType([MANIFEST_SCHEMA["metadata"], T.StructField("nodes", T.MapType(T.StringType(), node))])
    raw = spark.read.text(path, wholetext=one_per_file)
    # A generator's output is a column of its own: as a plain expression the document would be parsed again for each of
    # its fields and for the filter that an explode brings along.
    parsed = raw.select(F.col("_metadata.file_path").alias("path"), F.explode_outer(F.array(F.from_json("value", schema))).alias("m"))
    return parsed.select(F.coalesce("m.metadata.invocation_id", "path").alias("run_id"), F.col("m.nodes").alias("nodes"))
