"""Bronze ingest: a file-source Structured Streaming job appending arriving files to a Bronze table.

Each row gets ``_ingestion_timestamp`` (write time) and ``_source_file`` (the file it came from)
unless the landing files already carry them. Exactly-once through the checkpoint: a restart after
a lost executor or driver resumes from the last committed batch, and rerunning with
``availableNow`` processes only files not yet seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def landing_stream(spark: SparkSession, landing_dir: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    df = reader.parquet(landing_dir)
    if "_ingestion_timestamp" not in schema.fieldNames():
        df = df.withColumn("_ingestion_timestamp", F.current_timestamp())
    if "_source_file" not in schema.fieldNames():
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df


def ingest_to_bronze(spark: SparkSession, landing_dir: str, schema: T.StructType, bronze_dir: str,
                     checkpoint_dir: str, max_files_per_trigger: int | None = None) -> None:
    """Run until every landed file is appended (``availableNow``), then stop."""
    q = (landing_stream(spark, landing_dir, schema, max_files_per_trigger)
         .writeStream.format("parquet").outputMode("append")
         .option("path", bronze_dir).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_with(spark: SparkSession, landing_dir: str, schema: T.StructType, checkpoint_dir: str,
                handler: Callable[[DataFrame, int], None], max_files_per_trigger: int | None = None) -> None:
    """Same source, but each micro-batch goes to ``handler`` (``foreachBatch``)."""
    q = (landing_stream(spark, landing_dir, schema, max_files_per_trigger)
         .writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
