"""Bronze layer: explicit schemas and readers for the three raw, append-only feeds.

Raw types are never inferred. Parquet written by other tools often stores timestamps without a
zone, which Spark loads as ``timestamp_ntz``; every reader casts them to ``timestamp`` (session zone UTC).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_ORDERS_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("order_amount_eur", T.DecimalType(22, 4)),
    T.StructField("order_timestamp", T.TimestampType()),
    T.StructField("_ingestion_timestamp", T.TimestampType()),
    T.StructField("_source_file", T.StringType()),
])

RAW_CUSTOMERS_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("customer_segment", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("_ingestion_timestamp", T.TimestampType()),
])

RAW_TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("transaction_amount_eur", T.DecimalType(18, 2)),
    T.StructField("transaction_status", T.StringType()),
    T.StructField("transaction_timestamp", T.TimestampType()),
    T.StructField("_ingestion_timestamp", T.TimestampType()),
])

SCHEMAS = {
    "raw_orders": RAW_ORDERS_SCHEMA,
    "raw_customers": RAW_CUSTOMERS_SCHEMA,
    "raw_transactions": RAW_TRANSACTIONS_SCHEMA,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to its types (``timestamp_ntz`` -> ``timestamp``); a value
    that does not fit becomes NULL, which the ``not_null`` checks report, and does not stop the job."""
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_raw(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Scan one Bronze table stored as Parquet; filters and projections reach the scan."""
    schema = SCHEMAS[name]
    # Read with the files' own physical types, then conform: feeds may deliver numbers or dates as text.
    return conform(spark.read.parquet(path), schema)


def with_event_date(raw_transactions: DataFrame) -> DataFrame:
    """The stated partition column of the payment feed: the calendar day of the event."""
    return raw_transactions.withColumn("event_date", F.to_date("transaction_timestamp"))


def write_raw_transactions(raw_transactions: DataFrame, path: str, mode: str = "append") -> None:
    """Store the payment feed partitioned by ``event_date`` so date filters prune directories."""
    from ..operators.layout import partitioned_write
    partitioned_write(with_event_date(raw_transactions), path, "event_date", mode)


def ingested_until(raw: DataFrame, cutoff) -> DataFrame:
    """Bronze as it stood at ``cutoff``: rows whose ingestion time is not later."""
    if cutoff is None:
        return raw
    return raw.where(F.col("_ingestion_timestamp") <= F.lit(cutoff).cast("timestamp"))
