"""Silver staging models: dedup first, then type, normalise and filter the winning row.

Dedup comes before filtering: if the newest version of a key is a test record, future-dated or
non-positive, the key disappears; an older good version does not resurface. ``as_of`` replaces
the wall clock so reruns repeat; ``_dbt_loaded_at`` is ``as_of``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import full_name, money, norm_lower, norm_title, norm_upper, size_band, to_key
from ..operators.dedup import keep_latest

# Fixed values that must equal the reference's for the same results.
TEST_STATUSES = ["TEST", "DUMMY", "CANCELLED_TEST"]
DIGITAL_METHODS = ["CARD", "APPLE_PAY", "GOOGLE_PAY"]
PREMIUM_SEGMENT = "PREMIUM"
SUCCESS_STATUS = "COMPLETED"

ORDER_COLUMNS = ["order_id", "customer_id", "order_amount_eur", "order_status", "order_timestamp", "order_date",
                 "order_size_band", "_ingestion_timestamp", "_source_file", "_dbt_loaded_at"]
CUSTOMER_COLUMNS = ["customer_id", "first_name", "last_name", "email", "full_name", "country_code",
                    "customer_segment", "is_premium_customer", "created_at", "updated_at",
                    "_ingestion_timestamp", "_dbt_loaded_at"]
TRANSACTION_COLUMNS = ["transaction_id", "order_id", "payment_method", "transaction_amount_eur",
                       "transaction_status", "is_successful", "is_digital_payment", "transaction_timestamp",
                       "transaction_date", "_ingestion_timestamp", "_dbt_loaded_at"]


def _now(as_of):
    return F.lit(as_of).cast("timestamp")


def _keyed(raw: DataFrame, *keys: str) -> DataFrame:
    """Cast id columns to their Silver string form BEFORE the dedup window: the cast is one-to-one,
    so the groups are the same, and the window's hash partitioning on the string key is then the
    partitioning the Gold joins and aggregates need (no second shuffle of the table)."""
    for k in keys:
        raw = raw.withColumn(k, to_key(k))
    return raw


# How the versions of a key are ranked, first wins; all other columns follow, ascending.
RANKS = {"raw_orders": ("order_id", [("_ingestion_timestamp", "desc"), ("_source_file", "desc")]),
         "raw_customers": ("customer_id", [("updated_at", "desc"), ("_ingestion_timestamp", "desc")]),
         "raw_transactions": ("transaction_id", [("_ingestion_timestamp", "desc"), ("transaction_amount_eur", "desc"),
                                                 ("payment_method", "asc"), ("transaction_status", "asc")])}
_IDS = {"raw_orders": ("order_id", "customer_id"), "raw_customers": ("customer_id",), "raw_transactions": ("transaction_id", "order_id")}


def keyed(feed: str, raw: DataFrame) -> DataFrame:
    return _keyed(raw, *_IDS[feed])


def dedup(feed: str, raw: DataFrame, placed: Callable[[DataFrame], tuple[DataFrame, str]] | None = None) -> DataFrame:
    """The newest version of every key of a Bronze feed. ``placed`` puts another column in the place of the key and
    names it; there must be one value of it for each key."""
    key, rank = RANKS[feed]
    order = [F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_first() for c, way in rank]
    rows = keyed(feed, raw)
    if placed is not None:
        rows, key = placed(rows)
    return keep_latest(rows, key, order)


def dedup_orders(raw_orders: DataFrame) -> DataFrame:
    return dedup("raw_orders", raw_orders)


def dedup_customers(raw_customers: DataFrame) -> DataFrame:
    return dedup("raw_customers", raw_customers)


def dedup_transactions(raw_transactions: DataFrame) -> DataFrame:
    return dedup("raw_transactions", raw_transactions)


def order_shows(as_of) -> Column:
    """Whether Silver shows an order's newest event: neither a test record nor future-dated (NULL counts as no).

    ``NOT IN`` drops a NULL status (NULL NOT IN (...) is NULL).
    """
    return ~norm_upper("order_status").isin(TEST_STATUSES) & (F.col("order_timestamp").try_cast("timestamp") <= _now(as_of))


def orders_of(winners: DataFrame, as_of) -> DataFrame:
    """One row per order: the newest ingested event, unless it is a test record or future-dated (``order_shows``);
    a NULL amount lands in the last band."""
    ts = F.col("order_timestamp").try_cast("timestamp")
    return (winners
            .where(order_shows(as_of))
            .select(
                to_key("order_id").alias("order_id"),
                to_key("customer_id").alias("customer_id"),
                money("order_amount_eur").alias("order_amount_eur"),
                norm_upper("order_status").alias("order_status"),
                ts.alias("order_timestamp"),
                F.to_date(ts).alias("order_date"),
                size_band("order_amount_eur").alias("order_size_band"),
                F.col("_ingestion_timestamp").try_cast("timestamp").alias("_ingestion_timestamp"),
                F.col("_source_file").cast("string").alias("_source_file"),
                _now(as_of).alias("_dbt_loaded_at")))


def customers_of(winners: DataFrame, as_of) -> DataFrame:
    """One row per customer from the CRM snapshots: the latest ``updated_at`` wins."""
    return (winners
            .where(F.col("customer_id").isNotNull() & (F.col("customer_id").cast("string") != ""))
            .select(
                to_key("customer_id").alias("customer_id"),
                norm_title("first_name").alias("first_name"),
                norm_title("last_name").alias("last_name"),
                norm_lower("email").alias("email"),
                full_name("first_name", "last_name").alias("full_name"),
                norm_upper("country_code").alias("country_code"),
                norm_title("customer_segment").alias("customer_segment"),
                F.coalesce(norm_upper("customer_segment") == PREMIUM_SEGMENT, F.lit(False)).alias("is_premium_customer"),
                F.col("created_at").try_cast("timestamp").alias("created_at"),
                F.col("updated_at").try_cast("timestamp").alias("updated_at"),
                F.col("_ingestion_timestamp").try_cast("timestamp").alias("_ingestion_timestamp"),
                _now(as_of).alias("_dbt_loaded_at")))


def transactions_of(winners: DataFrame, as_of) -> DataFrame:
    """One row per payment: newest ingested event, kept only with a key and a positive amount."""
    ts = F.col("transaction_timestamp").try_cast("timestamp")
    status = norm_upper("transaction_status")
    method = norm_upper("payment_method")
    return (winners
            .where(F.col("transaction_id").isNotNull())
            .where(F.col("transaction_amount_eur").try_cast("decimal(18,2)") > 0)
            .select(
                to_key("transaction_id").alias("transaction_id"),
                to_key("order_id").alias("order_id"),
                method.alias("payment_method"),
                money("transaction_amount_eur").alias("transaction_amount_eur"),
                status.alias("transaction_status"),
                F.coalesce(status == SUCCESS_STATUS, F.lit(False)).alias("is_successful"),
                F.coalesce(method.isin(DIGITAL_METHODS), F.lit(False)).alias("is_digital_payment"),
                ts.alias("transaction_timestamp"),
                F.to_date(ts).alias("transaction_date"),
                F.col("_ingestion_timestamp").try_cast("timestamp").alias("_ingestion_timestamp"),
                _now(as_of).alias("_dbt_loaded_at")))


def stg_orders(raw_orders: DataFrame, as_of) -> DataFrame:
    return orders_of(dedup_orders(raw_orders), as_of)


def stg_customers(raw_customers: DataFrame, as_of) -> DataFrame:
    return customers_of(dedup_customers(raw_customers), as_of)


def stg_transactions(raw_transactions: DataFrame, as_of) -> DataFrame:
    return transactions_of(dedup_transactions(raw_transactions), as_of)


def views(winners: dict[str, DataFrame], as_of) -> dict[str, DataFrame]:
    """The Silver models over the winning versions of each feed."""
    return {"stg_orders": orders_of(winners["raw_orders"], as_of), "stg_customers": customers_of(winners["raw_customers"], as_of),
            "stg_transactions": transactions_of(winners["raw_transactions"], as_of)}


def silver(bronze: dict[str, DataFrame], as_of) -> dict[str, DataFrame]:
    return views({feed: dedup(feed, bronze[feed]) for feed in RANKS}, as_of)


def stg_transactions_for_orders(raw_transactions: DataFrame, order_ids: DataFrame, as_of) -> DataFrame:
    """Silver payments of the given orders only, without deduplicating the whole payment history.

    Exact: the winning version of a payment that belongs to one of the orders is itself a raw row
    with that ``order_id``, so keeping every version of each ``transaction_id`` that has such a row
    and deduplicating those gives the same winners; the winners are then narrowed to the orders.
    Both narrowing steps are left-semi joins against small key sets (AQE broadcasts them when
    their runtime size allows), so only the batch's payment rows are shuffled and sorted.
    """
    keys = order_ids.select(to_key("order_id").alias("order_id")).distinct()
    raw = _keyed(raw_transactions, "transaction_id", "order_id")
    touched = raw.join(keys, "order_id", "left_semi").select("transaction_id").distinct()
    versions = raw.join(touched, "transaction_id", "left_semi")
    return stg_transactions(versions, as_of).join(keys, "order_id", "left_semi")
