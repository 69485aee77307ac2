"""Declared assertions of the six models, the quality report and the source freshness report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import Check, run_checks

# Fixed values that must equal the reference's for the same results.
ORDER_STATUSES = ["PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED", "REFUNDED"]
SIZE_BANDS = ["small", "medium", "large", "enterprise"]
SEGMENTS = ["Standard", "Premium", "Wholesale", "Internal"]
TRANSACTION_STATUSES = ["PENDING", "COMPLETED", "FAILED", "REFUNDED", "CHARGEBACK"]
PAYMENT_METHODS = ["CARD", "BANK_TRANSFER", "APPLE_PAY", "GOOGLE_PAY", "VOUCHER", "CRYPTO"]
CUSTOMER_STATUSES = ["active", "lapsing", "churned", "never_ordered"]
EMAIL_REGEX = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
FRESHNESS_WARN_HOURS = 6
FRESHNESS_ERROR_HOURS = 24
TARGET_LAG_MINUTES = {"raw_orders": 60, "raw_customers": 1440, "raw_transactions": 30}


def _c(model, column, test, **args):
    return Check(model, column, test, args)


SILVER_CHECKS = [
    _c("stg_orders", "order_id", "not_null"), _c("stg_orders", "order_id", "unique"),
    _c("stg_orders", "customer_id", "not_null"),
    _c("stg_orders", "order_amount_eur", "not_null"),
    _c("stg_orders", "order_amount_eur", "between", min=0, max=1000000),
    _c("stg_orders", "order_status", "not_null"),
    _c("stg_orders", "order_status", "accepted_values", values=ORDER_STATUSES),
    _c("stg_orders", "order_size_band", "accepted_values", values=SIZE_BANDS),
    _c("stg_orders", "order_timestamp", "not_null"),
    _c("stg_orders", "order_timestamp", "of_type", type="timestamp"),
    _c("stg_customers", "customer_id", "not_null"), _c("stg_customers", "customer_id", "unique"),
    _c("stg_customers", "email", "not_null"),
    _c("stg_customers", "email", "matches_regex", regex=EMAIL_REGEX),
    _c("stg_customers", "country_code", "not_null"),
    _c("stg_customers", "country_code", "length_between", min=2, max=2),
    _c("stg_customers", "customer_segment", "accepted_values", values=SEGMENTS),
    _c("stg_transactions", "transaction_id", "not_null"), _c("stg_transactions", "transaction_id", "unique"),
    _c("stg_transactions", "order_id", "not_null"),
    _c("stg_transactions", "transaction_amount_eur", "not_null"),
    _c("stg_transactions", "transaction_amount_eur", "between", min=0.01, max=500000),
    _c("stg_transactions", "transaction_status", "accepted_values", values=TRANSACTION_STATUSES),
    _c("stg_transactions", "payment_method", "accepted_values", values=PAYMENT_METHODS),
]

GOLD_CHECKS = [
    _c("dim_customers", "customer_sk", "not_null"), _c("dim_customers", "customer_sk", "unique"),
    _c("dim_customers", "customer_id", "not_null"), _c("dim_customers", "customer_id", "unique"),
    _c("dim_customers", "customer_status", "accepted_values", values=CUSTOMER_STATUSES),
    _c("dim_customers", "lifetime_order_count", "between", min=0, max=100000),
    _c("fct_orders", "order_id", "not_null"), _c("fct_orders", "order_id", "unique"),
    _c("fct_orders", "customer_sk", "not_null"),
    _c("fct_orders", "customer_sk", "relationships", to="dim_customers", field="customer_sk"),
    _c("fct_orders", "net_revenue_eur", "not_null"),
    _c("fct_orders", "net_revenue_eur", "between", min=-50000, max=1000000),
    _c("fct_orders", "order_status", "accepted_values", values=ORDER_STATUSES),
    _c("mart_customer_lifetime", "customer_id", "not_null"), _c("mart_customer_lifetime", "customer_id", "unique"),
    _c("mart_customer_lifetime", "customer_status", "accepted_values", values=CUSTOMER_STATUSES),
    _c("mart_customer_lifetime", "lifetime_orders", "between", min=0, max=100000),
]

ALL_CHECKS = SILVER_CHECKS + GOLD_CHECKS


def dq_report(models: dict[str, DataFrame], tests: tuple[str, ...] | None = None) -> DataFrame:
    """All declared assertions (or only the given test kinds) in one table."""
    checks = [c for c in ALL_CHECKS if tests is None or c.test in tests]
    return run_checks(models, checks)


def freshness_report(bronze: dict[str, DataFrame], as_of) -> DataFrame:
    """Per source: newest load time, rows, lag to ``as_of`` in minutes, threshold status, lag target."""
    now = F.lit(as_of).cast("timestamp")
    parts = []
    for name, df in bronze.items():
        parts.append(df.agg(F.max("_ingestion_timestamp").alias("max_loaded_at"),
                            F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("source"), "max_loaded_at", "row_count",
                             F.lit(TARGET_LAG_MINUTES.get(name)).cast("bigint").alias("target_lag_minutes")))
    out = reduce(DataFrame.unionByName, parts)
    lag = F.floor((F.unix_seconds(now) - F.unix_seconds(F.col("max_loaded_at"))) / 60).cast("bigint")
    return (out.withColumn("lag_minutes", lag)
            .withColumn("status", F.when(F.col("lag_minutes").isNull(), "error")
                        .when(F.col("lag_minutes") > FRESHNESS_ERROR_HOURS * 60, "error")
                        .when(F.col("lag_minutes") > FRESHNESS_WARN_HOURS * 60, "warn")
                        .otherwise("pass"))
            .withColumn("meets_target", F.coalesce(F.col("lag_minutes") <= F.col("target_lag_minutes"), F.lit(False)))
            .select("source", "max_loaded_at", "row_count", "lag_minutes", "target_lag_minutes", "status",
                    "meets_target"))
