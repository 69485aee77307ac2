"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator ID of the blueprint.

All of them read the driver's tables in ``sf_dir`` (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from ..sources import derived
from . import pipeline

#: The clock of the freshness query: not before the newest row of any feed.
FRESH_AS_OF = "2001-11-04 05:00:00"
#: The first of the two customer snapshots sees what was loaded by then.
SNAPSHOT_PREV = "1995-01-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _models(spark, sf_dir):
    return pipeline.models_from_tables(spark, sf_dir)


# ---------------------------------------------------------------- sources

def _landed(spark, sf_dir, name):
    """One derived feed stored as its files and loaded with the Bronze reader (payments by event date)."""
    from ..sources.bronze import read_raw, write_raw_transactions
    path = _scratch(spark, name)
    feed = getattr(derived, name)(spark, sf_dir)
    if name == "raw_transactions":
        write_raw_transactions(feed, path)
    else:
        feed.write.parquet(path)
    return read_raw(spark, name, path)


@query("src_raw_orders")
def _src_raw_orders(spark, sf_dir):
    return _landed(spark, sf_dir, "raw_orders")


@query("src_raw_customers")
def _src_raw_customers(spark, sf_dir):
    return _landed(spark, sf_dir, "raw_customers")


@query("src_raw_transactions")
def _src_raw_transactions(spark, sf_dir):
    return _landed(spark, sf_dir, "raw_transactions")


# ---------------------------------------------------------------- models

for _name in ["stg_orders", "stg_customers", "stg_transactions", "dim_customers", "fct_orders",
              "mart_customer_lifetime"]:
    def _make(n):
        return lambda spark, sf_dir: _models(spark, sf_dir)[n]
    query(_name)(_make(_name))


@query("fct_orders_incremental")
def _fct_incremental(spark, sf_dir):
    """Fact after an incremental run at as_of upserted into the full build of the previous run."""
    return pipeline.incremental_from_tables(spark, sf_dir).tables["fct_orders"]


@query("mart_customer_lifetime_incremental")
def _mart_incremental(spark, sf_dir):
    return pipeline.incremental_from_tables(spark, sf_dir).tables["mart_customer_lifetime"]


# ---------------------------------------------------------------- quality and freshness

@query("dq_report")
def _dq_report(spark, sf_dir):
    """All 41 declared assertions over the six models."""
    from .reports import dq_report
    return dq_report(_models(spark, sf_dir))


for _test in ["not_null", "unique", "accepted_values", "between", "matches_regex", "length_between",
              "relationships"]:
    def _make_dq(t):
        def fn(spark, sf_dir):
            from .reports import dq_report
            return dq_report(_models(spark, sf_dir), tests=(t,))
        return fn
    query(f"dq_{_test}")(_make_dq(_test))


@query("freshness_report")
def _freshness(spark, sf_dir):
    from .reports import freshness_report
    return freshness_report(derived.bronze(spark, sf_dir), FRESH_AS_OF)


# ---------------------------------------------------------------- projections (§2.3)

def _bronze(spark, sf_dir):
    return derived.bronze(spark, sf_dir)


def _proj(name, table, cols):
    """A projection query over one Bronze feed: ``cols`` maps output name -> Column factory."""
    def fn(spark, sf_dir):
        raw = _bronze(spark, sf_dir)[table]
        return raw.select(*[f().alias(n) for n, f in cols.items()])
    query(name)(fn)


def _register_projections():
    from pyspark.sql import functions as F

    from ..functions import columns as C
    _proj("proj_cast_keys", "raw_orders", {
        "order_id": lambda: C.to_key("order_id"), "customer_id": lambda: C.to_key("customer_id")})
    _proj("proj_money", "raw_orders", {
        "order_id": lambda: F.col("order_id"), "order_amount_eur": lambda: C.money("order_amount_eur")})
    _proj("proj_timestamps", "raw_transactions", {
        "transaction_id": lambda: F.col("transaction_id"),
        "transaction_timestamp": lambda: F.col("transaction_timestamp").try_cast("timestamp"),
        "transaction_date": lambda: F.to_date(F.col("transaction_timestamp").try_cast("timestamp"))})
    _proj("proj_normalise_upper", "raw_transactions", {
        "transaction_id": lambda: F.col("transaction_id"),
        "payment_method": lambda: C.norm_upper("payment_method"),
        "transaction_status": lambda: C.norm_upper("transaction_status")})
    _proj("proj_normalise_lower", "raw_customers", {
        "customer_id": lambda: F.col("customer_id"), "email": lambda: C.norm_lower("email")})
    _proj("proj_normalise_title", "raw_customers", {
        "customer_id": lambda: F.col("customer_id"), "first_name": lambda: C.norm_title("first_name"),
        "last_name": lambda: C.norm_title("last_name"), "customer_segment": lambda: C.norm_title("customer_segment")})
    _proj("proj_full_name", "raw_customers", {
        "customer_id": lambda: F.col("customer_id"), "full_name": lambda: C.full_name("first_name", "last_name")})
    _proj("proj_size_band", "raw_orders", {
        "order_id": lambda: F.col("order_id"), "order_amount_eur": lambda: F.col("order_amount_eur"),
        "order_size_band": lambda: C.size_band("order_amount_eur")})


_register_projections()


def _model_cols(name, model, cols):
    query(name)(lambda spark, sf_dir: _models(spark, sf_dir)[model].select(*cols))


_model_cols("proj_flags", "stg_transactions", ["transaction_id", "is_successful", "is_digital_payment"])
_model_cols("proj_defaults", "dim_customers",
            ["customer_id", "lifetime_order_count", "lifetime_order_value_eur", "distinct_order_days"])
_model_cols("proj_net_revenue", "fct_orders", ["order_id", "order_amount_eur", "refunded_amount_eur", "net_revenue_eur"])
_model_cols("proj_customer_status", "dim_customers", ["customer_id", "last_order_at", "customer_status"])
_model_cols("proj_days_since", "mart_customer_lifetime", ["customer_id", "last_order_at", "days_since_last_order"])
_model_cols("pii_mask", "dim_customers", ["customer_id", "email_hash"])
_model_cols("surrogate_key", "dim_customers", ["customer_id", "customer_sk"])


# ---------------------------------------------------------------- filters (§2.3)

@query("filter_test_records")
def _filter_test_records(spark, sf_dir):
    """Newest order versions that are not test records (NULL status drops too)."""
    from pyspark.sql import functions as F

    from ..functions.columns import norm_upper
    from .silver import TEST_STATUSES, dedup_orders
    return (dedup_orders(_bronze(spark, sf_dir)["raw_orders"])
            .where(~norm_upper("order_status").isin(TEST_STATUSES)).select("order_id", F.col("order_status")))


@query("filter_future")
def _filter_future(spark, sf_dir):
    """Newest order versions whose event time is not after as_of."""
    from pyspark.sql import functions as F

    from .silver import dedup_orders
    return (dedup_orders(_bronze(spark, sf_dir)["raw_orders"])
            .where(F.col("order_timestamp") <= F.lit(pipeline.AS_OF).cast("timestamp"))
            .select("order_id", "order_timestamp"))


@query("filter_valid_key")
def _filter_valid_key(spark, sf_dir):
    from pyspark.sql import functions as F

    from .silver import dedup_customers
    return (dedup_customers(_bronze(spark, sf_dir)["raw_customers"])
            .where(F.col("customer_id").isNotNull() & (F.col("customer_id").cast("string") != ""))
            .select("customer_id", "updated_at"))


@query("filter_positive")
def _filter_positive(spark, sf_dir):
    from pyspark.sql import functions as F

    from .silver import dedup_transactions
    return (dedup_transactions(_bronze(spark, sf_dir)["raw_transactions"])
            .where(F.col("transaction_amount_eur").try_cast("decimal(18,2)") > 0)
            .select("transaction_id", "transaction_amount_eur"))


@query("filter_not_cancelled")
def _filter_not_cancelled(spark, sf_dir):
    from pyspark.sql import functions as F
    return (_models(spark, sf_dir)["stg_orders"].where(F.col("order_status") != "CANCELLED")
            .select("order_id", "customer_id", "order_status"))


@query("filter_fulfilled")
def _filter_fulfilled(spark, sf_dir):
    from pyspark.sql import functions as F
    return _models(spark, sf_dir)["fct_orders"].where(F.col("is_fulfilled")).select("order_id", "customer_id")


@query("filter_lookback")
def _filter_lookback(spark, sf_dir):
    """The incremental batch of the fact: orders within the look-back of the previous run's newest order."""
    return pipeline.incremental_from_tables(spark, sf_dir).fct_batch


# ---------------------------------------------------------------- joins (§2.4)

@query("join_customer_stats")
def _join_customer_stats(spark, sf_dir):
    from .gold import order_stats
    m = _models(spark, sf_dir)
    return (m["stg_customers"].select("customer_id", "email")
            .join(order_stats(m["stg_orders"]), "customer_id", "left")
            .select("customer_id", "email", "lifetime_order_count", "last_order_at"))


@query("join_order_payments")
def _join_order_payments(spark, sf_dir):
    from .gold import payments_per_order
    m = _models(spark, sf_dir)
    return (m["stg_orders"].select("order_id", "order_amount_eur")
            .join(payments_per_order(m["stg_transactions"]), "order_id", "left")
            .select("order_id", "order_amount_eur", "transaction_count", "refunded_amount_eur"))


@query("join_order_customer")
def _join_order_customer(spark, sf_dir):
    m = _models(spark, sf_dir)
    dim = m["dim_customers"].select("customer_id", "customer_sk", "customer_segment", "is_premium_customer")
    return (m["stg_orders"].select("order_id", "customer_id").join(dim, "customer_id", "left")
            .select("order_id", "customer_id", "customer_sk", "customer_segment", "is_premium_customer"))


@query("join_mart")
def _join_mart(spark, sf_dir):
    from .gold import customer_features
    m = _models(spark, sf_dir)
    feats = customer_features(m["fct_orders"], pipeline.AS_OF).select("customer_id", "lifetime_orders", "last_order_at")
    return m["dim_customers"].select("customer_id", "customer_status").join(feats, "customer_id", "left")


@query("semi_recent_customers")
def _semi_recent(spark, sf_dir):
    """Customers of the incremental mart batch: those with a fulfilled order in the look-back."""
    return pipeline.incremental_from_tables(spark, sf_dir).mart_batch.select("customer_id", "lifetime_orders")


@query("anti_orphans")
def _anti_orphans(spark, sf_dir):
    """Payments whose order has no Silver row (test, future-dated or never sent): left anti join."""
    from pyspark.sql import functions as F
    m = _models(spark, sf_dir)
    return (m["stg_transactions"].where(F.col("order_id").isNotNull())
            .join(m["stg_orders"].select("order_id"), "order_id", "left_anti")
            .select("transaction_id", "order_id"))


@query("scalar_subquery_max")
def _scalar_max(spark, sf_dir):
    """The look-back bound of an incremental run: a one-row aggregate over the previous fact."""
    from pyspark.sql import functions as F
    prev = pipeline.models_from_tables(spark, sf_dir, pipeline.PREV, cutoff=pipeline.PREV)["fct_orders"]
    return prev.agg(F.max("order_timestamp").alias("max_order_timestamp")).select(
        "max_order_timestamp", (F.col("max_order_timestamp") - F.expr("INTERVAL 3 DAYS")).alias("lookback_from"))


# ---------------------------------------------------------------- windows (§2.5)

@query("dedup_orders")
def _dedup_orders(spark, sf_dir):
    from .silver import dedup_orders
    return dedup_orders(_bronze(spark, sf_dir)["raw_orders"])


@query("dedup_customers")
def _dedup_customers(spark, sf_dir):
    from .silver import dedup_customers
    return dedup_customers(_bronze(spark, sf_dir)["raw_customers"])


@query("dedup_transactions")
def _dedup_transactions(spark, sf_dir):
    from .silver import dedup_transactions
    return dedup_transactions(_bronze(spark, sf_dir)["raw_transactions"])


@query("rolling_sum")
def _rolling_sum(spark, sf_dir):
    """30-day rolling order value per customer over Silver orders (RANGE frame on order_date)."""
    from pyspark.sql import functions as F

    from ..functions.columns import rolling_sum
    orders = _models(spark, sf_dir)["stg_orders"].select("order_id", "customer_id", "order_date", "order_amount_eur")
    out = rolling_sum(orders, "order_amount_eur", "order_date", 30, alias="order_amount_30d")
    return out.withColumn("order_amount_30d", F.col("order_amount_30d").cast("decimal(38,2)"))


# ---------------------------------------------------------------- aggregations (§2.6)

@query("agg_order_stats")
def _agg_order_stats(spark, sf_dir):
    from pyspark.sql import functions as F

    from .gold import order_stats
    out = order_stats(_models(spark, sf_dir)["stg_orders"])
    return out.withColumn("lifetime_order_value_eur", F.col("lifetime_order_value_eur").cast("decimal(38,2)"))


def _money38(df, cols):
    from pyspark.sql import functions as F
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("decimal(38,2)"))
    return df


@query("agg_payments")
def _agg_payments(spark, sf_dir):
    from .gold import payments_per_order
    return _money38(payments_per_order(_models(spark, sf_dir)["stg_transactions"]),
                    ["paid_amount_eur", "refunded_amount_eur"])


@query("agg_customer_features")
def _agg_customer_features(spark, sf_dir):
    from .gold import customer_features
    return _money38(customer_features(_models(spark, sf_dir)["fct_orders"], pipeline.AS_OF),
                    ["lifetime_revenue_eur", "revenue_last_30d", "revenue_last_90d", "revenue_last_365d",
                     "total_refunded_eur"])


def _feature_subset(name, cols):
    def fn(spark, sf_dir):
        from .gold import customer_features
        f = customer_features(_models(spark, sf_dir)["fct_orders"], pipeline.AS_OF)
        return _money38(f.select("customer_id", *cols), [c for c in cols if "revenue" in c or "refunded" in c])
    query(name)(fn)


_feature_subset("agg_windowed_counts", ["orders_last_7d", "orders_last_30d", "orders_last_90d", "orders_last_365d"])
_feature_subset("agg_windowed_sums", ["revenue_last_30d", "revenue_last_90d", "revenue_last_365d"])
_feature_subset("agg_basic", ["lifetime_revenue_eur", "avg_order_value_eur", "total_refunded_eur",
                              "first_order_at", "last_order_at"])
_feature_subset("agg_tenure", ["customer_tenure_days"])


@query("agg_windowed_as_of")
def _agg_windowed_as_of(spark, sf_dir):
    """Look-back counts and sums at two as-of dates from kept (customer, day) totals: those of the previous run's fact,
    brought forward by the days that an upsert of the fact rewrote. The fact is not read for the features."""
    from functools import reduce

    from pyspark.sql import functions as F

    from ..operators.upsert import PartitionedTable
    from .customer_days import CustomerDays, features_as_of
    from .gold import fct_orders
    root = _scratch(spark, "as_of")
    fact = PartitionedTable(spark, f"{root}/fct", "order_date")
    cols = ["order_id", "customer_id", "order_date", "net_revenue_eur", "is_fulfilled"]

    def built(as_of, cutoff=None):
        # The dimension gives none of these columns. Told that it has one row per customer, Spark leaves its join out.
        m = pipeline.models_from_tables(spark, sf_dir, as_of, cutoff=cutoff)
        return fct_orders(m["stg_orders"], m["stg_transactions"], m["dim_customers"].dropDuplicates(["customer_id"]), as_of).select(*cols)

    fact.write(built(pipeline.PREV, pipeline.PREV))
    days = CustomerDays(spark, root)
    days.rebuild(fact)
    # What is new or different now is upserted, whatever its date. Both have one row per order and meet by it: what was built
    # is not moved again. Orders without a key are never upserted.
    now, then = built(pipeline.AS_OF).alias("n"), fact.read().alias("t")
    same = reduce(lambda a, b: a & b, [F.col(f"n.{c}").eqNullSafe(F.col(f"t.{c}")) for c in cols[1:]])
    fact.upsert(now.join(then, (F.col("n.order_id") == F.col("t.order_id")) & same, "left_anti"), "order_id")
    days.advance(fact)
    parts = [features_as_of(days.table.read(), d).withColumn("as_of", F.lit(d).cast("timestamp")) for d in (pipeline.PREV, pipeline.AS_OF)]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("agg_count_distinct")
def _agg_count_distinct(spark, sf_dir):
    """A genuine distinct count per customer: order days (not unique in their input)."""
    from pyspark.sql import functions as F
    m = _models(spark, sf_dir)
    days = m["stg_orders"].groupBy("customer_id").agg(F.count_distinct("order_date").alias("distinct_order_days"))
    return days


@query("agg_conditional")
def _agg_conditional(spark, sf_dir):
    from .gold import payments_per_order
    p = payments_per_order(_models(spark, sf_dir)["stg_transactions"])
    return _money38(p.select("order_id", "paid_amount_eur", "refunded_amount_eur", "last_paid_at"),
                    ["paid_amount_eur", "refunded_amount_eur"])


@query("agg_bool_or")
def _agg_bool_or(spark, sf_dir):
    from .gold import payments_per_order
    return payments_per_order(_models(spark, sf_dir)["stg_transactions"]).select("order_id", "has_chargeback")


@query("agg_mode")
def _agg_mode(spark, sf_dir):
    from .gold import customer_features
    f = customer_features(_models(spark, sf_dir)["fct_orders"], pipeline.AS_OF)
    return f.select("customer_id", "preferred_payment_method", "typical_order_size")


# ---------------------------------------------------------------- scalar macros (§2.7)

@query("safe_divide")
def _safe_divide(spark, sf_dir):
    """Refund share of the paid amount per order; NULL when nothing was paid."""
    from pyspark.sql import functions as F

    from ..functions.columns import safe_divide
    f = _models(spark, sf_dir)["fct_orders"]
    return f.select("order_id", safe_divide(F.col("refunded_amount_eur").cast("double"),
                                            F.col("paid_amount_eur").cast("double")).alias("refund_share"))


@query("days_between")
def _days_between(spark, sf_dir):
    from ..functions.columns import days_between
    c = _models(spark, sf_dir)["stg_customers"]
    return c.select("customer_id", days_between("created_at", "updated_at").alias("days_created_to_updated"))


# ---------------------------------------------------------------- table writes (§2.1)

def _scratch(spark, name):
    from ..session import scratch_path
    return scratch_path(spark, name)


@query("silver_view")
def _silver_view(spark, sf_dir):
    """Silver is a view: registered lazily, recomputed on read."""
    _models(spark, sf_dir)["stg_orders"].createOrReplaceTempView("stg_orders")
    return spark.table("stg_orders")


@query("gold_overwrite")
def _gold_overwrite(spark, sf_dir):
    """The dimension materialised as a full overwrite, clustered on customer_id, read back."""
    from ..operators.layout import clustered_write
    path = _scratch(spark, "dim_customers")
    clustered_write(_models(spark, sf_dir)["dim_customers"], path, ["customer_id"])
    return spark.read.parquet(path)


@query("incremental_merge")
def _incremental_merge(spark, sf_dir):
    """Mart upserted into a versioned table: full build at the previous run, then a merged version."""
    return pipeline.incremental_from_tables(spark, sf_dir).tables["mart_customer_lifetime"]


@query("partitioned_write")
def _partitioned_write(spark, sf_dir):
    """Fact stored partitioned by order_date (clustered inside); the incremental batch rewrites only
    the touched partitions."""
    return pipeline.incremental_from_tables(spark, sf_dir).tables["fct_orders"]


@query("layout_by")
def _layout_by(spark, sf_dir):
    """Mart clustered on (customer_segment, customer_status) by z-value, written and read back."""
    from ..operators.layout import clustered_write
    path = _scratch(spark, "mart_layout")
    clustered_write(_models(spark, sf_dir)["mart_customer_lifetime"], path, ["customer_segment", "customer_status"])
    return spark.read.parquet(path)


@query("analyze_stats")
def _analyze_stats(spark, sf_dir):
    """The stored fact's statistics as ANALYZE put them into the catalog (row, NULL counts, longest string)."""
    import uuid

    from ..operators.layout import analyzed_columns, register_table
    path, name = _scratch(spark, "fct_stats"), f"fct_orders_{uuid.uuid4().hex[:8]}"
    _models(spark, sf_dir)["fct_orders"].write.mode("overwrite").parquet(path)
    register_table(spark, name, path)
    try:
        return analyzed_columns(spark, name)
    finally:
        spark.sql(f"DROP TABLE {name}")


@query("audit_append")
def _audit_append(spark, sf_dir):
    """Row counts of three models; the log is written twice, as by a rerun, and holds each run once."""
    from ..operators.audit import audit_append, read_audit
    m = _models(spark, sf_dir)
    path = _scratch(spark, "audit_log")
    for name in ["dim_customers", "fct_orders", "mart_customer_lifetime", "dim_customers"]:
        audit_append(m[name], path, name, "prod", pipeline.AS_OF)
    return read_audit(spark, path)


def _two_marts(spark, sf_dir):
    before = pipeline.models_from_tables(spark, sf_dir, pipeline.PREV, cutoff=pipeline.PREV)["mart_customer_lifetime"]
    after = _models(spark, sf_dir)["mart_customer_lifetime"]
    return before, after


@query("audit_compare")
def _audit_compare(spark, sf_dir):
    """Mart of the previous run against the mart now: rows added / removed / changed per column."""
    from ..operators.audit import audit_compare
    before, after = _two_marts(spark, sf_dir)
    return audit_compare(before, after, "customer_id")


@query("feature_publish")
def _feature_publish(spark, sf_dir):
    """Customers whose features changed since the previous run (what goes to the feature topic)."""
    from ..operators.publish import changed_rows
    before, after = _two_marts(spark, sf_dir)
    return changed_rows(before, after, "customer_id")


@query("feature_publish_records")
def _feature_publish_records(spark, sf_dir):
    """The same changes as key / JSON value / topic records, written to the sink, read back and parsed."""
    from pyspark.sql import functions as F

    from ..operators.publish import changed_rows, publish, to_records
    before, after = _two_marts(spark, sf_dir)
    changes = changed_rows(before, after, "customer_id")
    path = _scratch(spark, "feature_records")
    publish(to_records(changes, "customer_id"), sink="parquet", path=path)
    sent = spark.read.parquet(path)
    return sent.select("key", "topic", F.from_json("value", changes.schema).alias("v")).select("key", "topic", "v.*")


def _customer_versions(spark, sf_dir):
    """Typed CRM rows of every snapshot (Silver projections, before dedup)."""
    from pyspark.sql import functions as F

    from ..functions.columns import full_name, norm_lower, norm_title, norm_upper, to_key
    raw = _bronze(spark, sf_dir)["raw_customers"]
    return raw.where(F.col("customer_id").isNotNull()).select(
        to_key("customer_id").alias("customer_id"), norm_title("first_name").alias("first_name"),
        norm_title("last_name").alias("last_name"), norm_lower("email").alias("email"),
        full_name("first_name", "last_name").alias("full_name"), norm_upper("country_code").alias("country_code"),
        norm_title("customer_segment").alias("customer_segment"), "created_at", "updated_at", "_ingestion_timestamp")


@query("snapshot_scd2")
def _snapshot_scd2(spark, sf_dir):
    """Type-2 customer history: the CRM state of the previous run, stored, then closed and extended by the state now."""
    from ..operators.history import snapshot_scd2
    from ..operators.upsert import VersionedTable
    from ..sources.bronze import ingested_until
    versions = _customer_versions(spark, sf_dir)
    history = VersionedTable(spark, _scratch(spark, "customer_history"))
    for cutoff in (SNAPSHOT_PREV, None):
        history.write(snapshot_scd2(history.read(), ingested_until(versions, cutoff), "customer_id"))
    return history.read().drop("_ingestion_timestamp")


@query("history_from_versions")
def _history_from_versions(spark, sf_dir):
    """Type-2 customer history over all CRM snapshots in updated_at order, in one pass."""
    from ..operators.history import history_from_versions
    return history_from_versions(_customer_versions(spark, sf_dir), "customer_id").drop("_ingestion_timestamp")


# ---------------------------------------------------------------- seeds and streams

@query("seed_load")
def _seed_load(spark, sf_dir):
    """A country lookup seed: the nation table exported as CSV, loaded with a schema, stored."""
    from ..sources.seeds import load_seed, write_seed
    csv = _scratch(spark, "seed_csv")
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.option("header", True).csv(csv)
    out = _scratch(spark, "seeds_nation")
    write_seed(load_seed(spark, csv, "n_nationkey INT, n_name STRING, n_regionkey INT"), out)
    return spark.read.parquet(out)


@query("bronze_ingest_stream")
def _bronze_ingest_stream(spark, sf_dir):
    """Order events landed as several files, appended to Bronze by a file stream (one file per
    trigger), then read back: every landed row exactly once, with its audit columns set."""
    from pyspark.sql import functions as F

    from ..sources.bronze import RAW_ORDERS_SCHEMA
    from ..streaming.ingest import ingest_to_bronze
    cols = ["order_id", "customer_id", "order_status", "order_amount_eur", "order_timestamp"]
    landing = _scratch(spark, "landing_orders")
    derived.raw_orders(spark, sf_dir).select(*cols).repartition(4).write.parquet(landing)
    schema = RAW_ORDERS_SCHEMA.__class__([f for f in RAW_ORDERS_SCHEMA.fields if f.name in cols])
    bronze_dir, ckpt = _scratch(spark, "bronze_orders"), _scratch(spark, "ckpt_orders")
    ingest_to_bronze(spark, landing, schema, bronze_dir, ckpt, max_files_per_trigger=1)
    ingest_to_bronze(spark, landing, schema, bronze_dir, ckpt, max_files_per_trigger=1)  # rerun: no duplicates
    out = spark.read.parquet(bronze_dir)
    return out.select(*cols, (F.col("_ingestion_timestamp").isNotNull() & F.col("_source_file").isNotNull())
                      .alias("has_audit_columns"))


@query("late_data_lookback")
def _late_data_lookback(spark, sf_dir):
    """Two daily runs fed by a stream of order files: the previous run's files, then the rest. The stream's state holds
    the newest version of every order; each micro-batch upserts the look-back window of the partitioned fact."""
    from pyspark.sql import functions as F

    from ..operators.upsert import PartitionedTable, VersionedTable
    from ..sources.bronze import RAW_ORDERS_SCHEMA
    from ..streaming.ingest import landing_stream
    from ..streaming.late_data import fact_upsert_handler, run_changes
    landing, ckpt = _scratch(spark, "landing_late"), _scratch(spark, "ckpt_late")
    fact = PartitionedTable(spark, _scratch(spark, "fct_late"), "order_date")
    waiting = VersionedTable(spark, _scratch(spark, "late_waiting"))
    orders = derived.raw_orders(spark, sf_dir)
    prev_ts = F.lit(pipeline.PREV).cast("timestamp")
    runs = [(pipeline.PREV, orders.where(F.col("_ingestion_timestamp") <= prev_ts), pipeline.PREV),
            (pipeline.AS_OF, orders.where(F.col("_ingestion_timestamp") > prev_ts), None)]
    for as_of, files, cutoff in runs:
        files.write.mode("append").parquet(landing)

        def others(c=cutoff):
            return {"raw_customers": derived.raw_customers(spark, sf_dir, c),
                    "raw_transactions": derived.raw_transactions(spark, sf_dir, c)}
        handler = fact_upsert_handler(spark, fact, waiting, others, lambda a=as_of: a)
        run_changes(landing_stream(spark, landing, RAW_ORDERS_SCHEMA), "raw_orders", ckpt, handler)
    return fact.read()


# ---------------------------------------------------------------- lineage and classification (§2.11)

def _lineage(spark, sf_dir, without):
    from ..sources.manifests import read_manifests
    from .lineage import lineage_models
    path = _scratch(spark, "manifests")
    # Manifests repeat the same few words: compressed, and in files that tasks can share as no task can start inside one.
    derived.run_manifests(spark, sf_dir).write.option("maxRecordsPerFile", 50_000).text(path, compression="lz4")
    return lineage_models(read_manifests(spark, path, one_per_file=False, without=without))


@query("lineage_models")
def _lineage_models(spark, sf_dir):
    from .lineage import public
    return public(_lineage(spark, sf_dir, ("columns", "depends_on"))).drop("entity_id")


@query("lineage_columns")
def _lineage_columns(spark, sf_dir):
    from .lineage import lineage_columns
    return lineage_columns(_lineage(spark, sf_dir, ("tags", "description", "depends_on")))


@query("lineage_edges")
def _lineage_edges(spark, sf_dir):
    from .lineage import lineage_edges
    return lineage_edges(_lineage(spark, sf_dir, ("tags", "description", "columns")))


@query("classify_columns")
def _classify_columns(spark, sf_dir):
    """E-mail columns: Silver customers (anchored pattern) and document text (unanchored)."""
    from ..operators.classify import EMAIL_FIELD, EMAIL_TEXT, classify_columns
    cust = classify_columns(_models(spark, sf_dir)["stg_customers"], "stg_customers", EMAIL_FIELD)
    docs = classify_columns(spark.read.parquet(f"{sf_dir}/documents.parquet"), "documents", EMAIL_TEXT)
    return cust.unionByName(docs)
