"""Gold models: customer dimension, order fact, customer-lifetime mart.

Each is a function of lazy Silver/Gold DataFrames and ``as_of``. Incremental modes take the current
target and return only the rows to upsert (the merge itself is ``operators.upsert``).

Shuffle plan per run: one exchange per grain. Payments aggregate on ``order_id`` (partial
aggregation before the shuffle), orders join them on the same key (no extra exchange when the
partitioning is reused), the dimension joins on ``customer_id`` (AQE turns it into a broadcast only
when the pruned four-column dimension is below the broadcast threshold, and splits skewed keys
otherwise), and the mart aggregates on ``customer_id``.

Distinct counts over a column that is unique in its input (``order_id`` in Silver orders and in
the fact, ``transaction_id`` in Silver payments) are written as plain ``count``: identical results
without the ``Expand`` that Spark plans for several distinct aggregates in one group-by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import customer_status, days_since, email_hash, surrogate_key

LOOKBACK_DAYS = 3          # incremental look-back, fixed value of the reference
MART_WINDOWS = (7, 30, 90, 365)
MART_REVENUE_WINDOWS = (30, 90, 365)
MONEY_SUM = "decimal(38,2)"

DIM_COLUMNS = ["customer_sk", "customer_id", "full_name", "email_hash", "country_code", "customer_segment",
               "is_premium_customer", "lifetime_order_count", "lifetime_order_value_eur", "first_order_at",
               "last_order_at", "distinct_order_days", "customer_status", "created_at", "updated_at",
               "_dbt_loaded_at"]
FCT_COLUMNS = ["order_id", "customer_sk", "customer_id", "order_date", "order_timestamp", "order_status",
               "order_size_band", "order_amount_eur", "customer_segment", "is_premium_customer",
               "transaction_count", "paid_amount_eur", "refunded_amount_eur", "last_paid_at", "has_chargeback",
               "primary_payment_method", "net_revenue_eur", "is_fulfilled", "_ingestion_timestamp",
               "_dbt_loaded_at"]
MART_COLUMNS = ["customer_id", "customer_sk", "country_code", "customer_segment", "is_premium_customer",
                "customer_status", "lifetime_orders", "lifetime_revenue_eur", "avg_order_value_eur",
                "orders_last_7d", "orders_last_30d", "orders_last_90d", "orders_last_365d", "revenue_last_30d",
                "revenue_last_90d", "revenue_last_365d", "chargeback_count", "total_refunded_eur", "is_high_risk",
                "preferred_payment_method", "typical_order_size", "customer_tenure_days",
                "days_since_last_order", "first_order_at", "last_order_at", "customer_created_at",
                "_dbt_loaded_at"]


def _now(as_of):
    return F.lit(as_of).cast("timestamp")


def _zero_money(c):
    return F.coalesce(F.col(c), F.lit(0)).cast(MONEY_SUM)


# ---------------------------------------------------------------- dimension

def order_stats(stg_orders: DataFrame) -> DataFrame:
    """Per customer over every non-cancelled Silver order (PENDING and REFUNDED count too)."""
    return (stg_orders.where(F.col("order_status") != "CANCELLED")
            .groupBy("customer_id")
            .agg(F.count("order_id").alias("lifetime_order_count"),
                 F.sum("order_amount_eur").alias("lifetime_order_value_eur"),
                 F.min("order_timestamp").alias("first_order_at"),
                 F.max("order_timestamp").alias("last_order_at"),
                 F.count_distinct("order_date").alias("distinct_order_days")))


def dim_customers(stg_customers: DataFrame, stg_orders: DataFrame, as_of) -> DataFrame:
    """Type-1 customer dimension: masked e-mail, surrogate key, order statistics, health status."""
    c = stg_customers.alias("c")
    o = order_stats(stg_orders).alias("o")
    return (c.join(o, F.col("c.customer_id") == F.col("o.customer_id"), "left")
            .select(
                surrogate_key(F.col("c.customer_id")).alias("customer_sk"),
                F.col("c.customer_id"),
                F.col("c.full_name"),
                email_hash(F.col("c.email")).alias("email_hash"),
                F.col("c.country_code"), F.col("c.customer_segment"), F.col("c.is_premium_customer"),
                F.coalesce(F.col("o.lifetime_order_count"), F.lit(0)).alias("lifetime_order_count"),
                _zero_money("o.lifetime_order_value_eur").alias("lifetime_order_value_eur"),
                F.col("o.first_order_at"), F.col("o.last_order_at"),
                F.coalesce(F.col("o.distinct_order_days"), F.lit(0)).alias("distinct_order_days"),
                customer_status(F.col("o.last_order_at"), as_of).alias("customer_status"),
                F.col("c.created_at"), F.col("c.updated_at"),
                _now(as_of).alias("_dbt_loaded_at")))


# ---------------------------------------------------------------- fact

def payments_per_order(stg_transactions: DataFrame) -> DataFrame:
    """Per order: payment count, paid and refunded sums, last payment, any chargeback, main method.

    ``mode`` keeps a per-group count map that is merged map-side; ties go to the smallest value.
    """
    ok = F.col("is_successful")
    status = F.col("transaction_status")
    amount = F.col("transaction_amount_eur")
    return (stg_transactions.groupBy("order_id")
            .agg(F.count("transaction_id").alias("transaction_count"),
                 F.sum(F.when(ok, amount).otherwise(0)).cast(MONEY_SUM).alias("paid_amount_eur"),
                 F.sum(F.when(status == "REFUNDED", amount).otherwise(0)).cast(MONEY_SUM).alias("refunded_amount_eur"),
                 F.max(F.when(ok, F.col("transaction_timestamp"))).alias("last_paid_at"),
                 F.bool_or(status == "CHARGEBACK").alias("has_chargeback"),
                 F.mode("payment_method", deterministic=True).alias("primary_payment_method")))


def lookback_bound(target: DataFrame | None, column: str, days: int = LOOKBACK_DAYS):
    """``max(target.column) - days``, or None when there is no target or it is empty (full mode)."""
    if target is None:
        return None
    top = target.agg(F.max(F.unix_micros(column)).alias("m")).first()["m"]   # a number: no driver time zone
    if top is None:
        return None
    return F.timestamp_micros(F.lit(top)) - F.expr(f"INTERVAL {int(days)} DAYS")


def fct_orders(stg_orders: DataFrame, stg_transactions: DataFrame, dim: DataFrame, as_of,
               target: DataFrame | None = None, lookback_days: int = LOOKBACK_DAYS, bound=None) -> DataFrame:
    """One row per order with payment enrichment and net revenue.

    Incremental (``target`` given, not empty): only orders with ``order_timestamp`` at or after
    ``max(target.order_timestamp) - lookback_days`` are rebuilt; payments are first narrowed to the
    batch's orders with a left-semi join (same result, as payments are left-joined to orders).
    A refund for an order older than the look-back never reaches the fact: full mode is the cure.
    ``bound`` may be passed when already known (see ``pipeline.fact_lookback_bound``).
    """
    orders = stg_orders
    payments = stg_transactions
    if bound is None:
        bound = lookback_bound(target, "order_timestamp", lookback_days)
    if bound is not None:
        orders = orders.where(F.col("order_timestamp") >= bound)
        payments = payments.join(orders.select("order_id"), "order_id", "left_semi")
    o = orders.alias("o")
    t = payments_per_order(payments).alias("t")
    c = dim.select("customer_id", "customer_sk", "customer_segment", "is_premium_customer").alias("c")
    return (o.join(t, F.col("o.order_id") == F.col("t.order_id"), "left")
            .join(c, F.col("o.customer_id") == F.col("c.customer_id"), "left")
            .select(
                F.col("o.order_id"), F.col("c.customer_sk"), F.col("o.customer_id"),
                F.col("o.order_date"), F.col("o.order_timestamp"), F.col("o.order_status"),
                F.col("o.order_size_band"), F.col("o.order_amount_eur"),
                F.col("c.customer_segment"), F.col("c.is_premium_customer"),
                F.coalesce(F.col("t.transaction_count"), F.lit(0)).alias("transaction_count"),
                _zero_money("t.paid_amount_eur").alias("paid_amount_eur"),
                _zero_money("t.refunded_amount_eur").alias("refunded_amount_eur"),
                F.col("t.last_paid_at"),
                F.coalesce(F.col("t.has_chargeback"), F.lit(False)).alias("has_chargeback"),
                F.col("t.primary_payment_method"),
                (F.col("o.order_amount_eur") - F.coalesce(F.col("t.refunded_amount_eur"), F.lit(0)))
                .cast(MONEY_SUM).alias("net_revenue_eur"),
                (F.col("o.order_status") == "DELIVERED").alias("is_fulfilled"),
                F.col("o._ingestion_timestamp"),
                _now(as_of).alias("_dbt_loaded_at")))


# ---------------------------------------------------------------- mart

def customer_features(fct: DataFrame, as_of) -> DataFrame:
    """Per customer over fulfilled orders: lifetime, windowed (inclusive, on dates) and risk features."""
    today = F.to_date(_now(as_of))
    d = F.col("order_date")
    net = F.col("net_revenue_eur")
    oid = F.col("order_id")
    aggs = [F.count(oid).alias("lifetime_orders"),
            F.sum(net).alias("lifetime_revenue_eur"),
            (F.sum(net).cast("double") / F.count(net)).alias("avg_order_value_eur")]
    aggs += [F.count(F.when(d >= F.date_sub(today, n), oid)).alias(f"orders_last_{n}d") for n in MART_WINDOWS]
    aggs += [F.sum(F.when(d >= F.date_sub(today, n), net).otherwise(0)).alias(f"revenue_last_{n}d")
             for n in MART_REVENUE_WINDOWS]
    aggs += [F.mode("primary_payment_method", deterministic=True).alias("preferred_payment_method"),
             F.mode("order_size_band", deterministic=True).alias("typical_order_size"),
             F.count(F.when(F.col("has_chargeback"), oid)).alias("chargeback_count"),
             F.sum("refunded_amount_eur").alias("total_refunded_eur"),
             F.min("order_timestamp").alias("first_order_at"),
             F.max("order_timestamp").alias("last_order_at"),
             F.datediff(F.max(d), F.min(d)).cast("bigint").alias("customer_tenure_days")]
    return fct.where(F.col("is_fulfilled")).groupBy("customer_id").agg(*aggs)


def mart_customer_lifetime(dim: DataFrame, fct: DataFrame, as_of, target: DataFrame | None = None,
                           lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """One row per customer: dimension attributes plus order features (ML feature table).

    Incremental (``target`` given, not empty): only customers with a fulfilled order at or after
    ``max(target._dbt_loaded_at) - lookback_days`` are rebuilt, and the fact is narrowed to them
    before aggregating. Customers without recent orders keep stale window counts, and new customers
    without orders are not inserted; full mode is the cure.
    """
    bound = lookback_bound(target, "_dbt_loaded_at", lookback_days)
    customers = dim
    orders = fct
    if bound is not None:
        # order_date = date(order_timestamp) (UTC), so the implied date bound is exact and prunes
        # the fact's order_date partitions; the timestamp bound keeps the precise cut.
        recent = (fct.where((F.col("order_date") >= F.to_date(bound)) & F.col("is_fulfilled")
                            & (F.col("order_timestamp") >= bound))
                  .select("customer_id").distinct())
        customers = dim.join(recent, "customer_id", "left_semi")
        orders = fct.join(recent, "customer_id", "left_semi")
    c = customers.alias("c")
    o = customer_features(orders, as_of).alias("o")

    def z(col):
        return F.coalesce(F.col(f"o.{col}"), F.lit(0)).alias(col)

    def zm(col):
        return _zero_money(f"o.{col}").alias(col)

    return (c.join(o, F.col("c.customer_id") == F.col("o.customer_id"), "left")
            .select(
                F.col("c.customer_id"), F.col("c.customer_sk"), F.col("c.country_code"),
                F.col("c.customer_segment"), F.col("c.is_premium_customer"), F.col("c.customer_status"),
                z("lifetime_orders"), zm("lifetime_revenue_eur"),
                F.coalesce(F.col("o.avg_order_value_eur"), F.lit(0.0)).alias("avg_order_value_eur"),
                *[z(f"orders_last_{n}d") for n in MART_WINDOWS],
                *[zm(f"revenue_last_{n}d") for n in MART_REVENUE_WINDOWS],
                z("chargeback_count"), zm("total_refunded_eur"),
                (F.coalesce(F.col("o.chargeback_count"), F.lit(0)) > 0).alias("is_high_risk"),
                F.col("o.preferred_payment_method"), F.col("o.typical_order_size"),
                F.coalesce(F.col("o.customer_tenure_days"), F.lit(0)).cast("bigint").alias("customer_tenure_days"),
                days_since(F.col("o.last_order_at"), as_of).alias("days_since_last_order"),
                F.col("o.first_order_at"), F.col("o.last_order_at"),
                F.col("c.created_at").alias("customer_created_at"),
                _now(as_of).alias("_dbt_loaded_at")))
