"""Late data through the incremental look-back, driven by a stream of order events.

``changed_winners`` keeps the newest version of every order in the state store (RocksDB, partitioned by the key) and
emits, with each micro-batch, only the orders whose newest version changed; nothing of Bronze is read again. It is
a streaming aggregate, the maximum per key of one comparable struct, so it stays in the JVM, and a retried batch starts
from the state before it and emits the same rows.

The handler then rebuilds what the look-back model rebuilds, from rows of the window only: the changed orders, and
the other orders of the fact inside the look-back (three days before its newest committed order), read from the touched
``order_date`` partitions. Orders that Silver does not show (yet) - a test status, a date in the future - wait in a small
table as long as they are inside the window. Rows later than the look-back are missed, as in the batch model; a full run
repairs them. Payments and customers are narrowed to the batch's keys before they are deduplicated, unless the fact is empty: then the
batch is not bounded by a window, and all of them are deduplicated as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import surrogate_key
from ..operators.files import delete
from ..operators.upsert import PartitionedTable, VersionedTable
from ..plans import gold, pipeline, silver
from ..session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ORDER_COLUMNS = ["order_id", "customer_id", "order_amount_eur", "order_status", "order_timestamp", "order_date",
                 "order_size_band", "_ingestion_timestamp"]


def inverted(c: Column, dtype: T.DataType) -> Column:
    """A value whose order is the reverse of ``c``'s, and greatest for NULL (the reverse of ascending, NULLs first).

    Strings: the complement of their UTF-8 bytes in hexadecimal, and a letter that no digit reaches, so that
    a prefix stays before what it begins.
    """
    if isinstance(dtype, T.StringType):
        complement = F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210")
        return F.coalesce(F.concat(complement, F.lit("G")), F.lit("H"))
    number = F.unix_micros(c) if isinstance(dtype, T.TimestampType) else c
    return F.struct(c.isNull().alias("missing"), (-number).alias("value"))


def changed_winners(stream: DataFrame, feed: str) -> DataFrame:
    """The newest version of every key whose newest version came with this micro-batch (output mode ``update``)."""
    key, rank = silver.RANKS[feed]
    rows = silver.keyed(feed, stream)
    types = {f.name: f.dataType for f in rows.schema.fields}
    ways = [*rank, *[(c, "asc") for c in rows.columns if c != key and c not in dict(rank)]]
    order = [F.col(c) if way == "desc" else inverted(F.col(c), types[c]) for c, way in ways]
    # Of equal versions the first to arrive stays: a row that is sent again changes nothing.
    at = F.col("__at")
    best = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], (-F.unix_micros(at)).alias("arrived"), F.struct(*rows.columns).alias("row"))
    found = (rows.withColumn("__at", F.current_timestamp()).groupBy(F.col(key).alias("__key"))
             .agg(F.max(best).alias("best"), F.max(F.unix_micros(at)).alias("touched")))
    return found.where(F.col("best.arrived") == -F.col("touched")).select("best.row.*")


def run_changes(stream: DataFrame, feed: str, checkpoint_dir: str, handler: Callable[[DataFrame, int], None]) -> None:
    """Run ``handler`` on the changed winners of each micro-batch until all landed files are processed."""
    spark = stream.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        q = (changed_winners(stream, feed).writeStream.outputMode("update").foreachBatch(handler)
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    q.awaitTermination()


def fact_customers(raw_customers: DataFrame, as_of) -> DataFrame:
    """The customers' columns of the fact."""
    return silver.stg_customers(raw_customers, as_of).select(
        "customer_id", surrogate_key(F.col("customer_id")).alias("customer_sk"), "customer_segment", "is_premium_customer")


def customers_for(raw_customers: DataFrame, ids: DataFrame, as_of) -> DataFrame:
    """The same of the given customers only: all versions of theirs are kept, then deduplicated."""
    wanted = silver.keyed("raw_customers", raw_customers).join(ids.select("customer_id").distinct(), "customer_id", "left_semi")
    return fact_customers(wanted, as_of)


def fact_upsert_handler(spark: SparkSession, fact: PartitionedTable, waiting: VersionedTable,
                        others: Callable[[], dict[str, DataFrame]], clock: Callable[[], object]):
    """``foreachBatch`` handler over changed winners. ``waiting`` holds winners that Silver does not show yet,
    ``others()`` gives the customer and payment Bronze tables, ``clock()`` the run's as-of time."""

    def handle(changed: DataFrame, batch_id: int) -> None:
        as_of, raw = clock(), others()
        bound = pipeline.fact_lookback_bound(fact)
        inside = F.lit(True) if bound is None else F.coalesce(F.col("order_timestamp") >= bound, F.lit(False))
        parked, stages = waiting.read(), [scratch_path(spark, "late-changed"), scratch_path(spark, "late-known")]

        def kept(df: DataFrame, path: str) -> DataFrame:
            df.write.parquet(path)
            return spark.read.schema(df.schema).parquet(path)

        known = kept(changed, stages[0])   # the micro-batch is worked out once
        if parked is not None:
            known = kept(known.unionByName(parked.join(known.select("order_id"), "order_id", "left_anti")), stages[1])
        shown = silver.orders_of(known, as_of).where(inside).select(*ORDER_COLUMNS)
        shows = F.coalesce(silver.order_shows(as_of) & inside, F.lit(False)) & F.col("order_id").isNotNull()
        orders, hidden = shown, known.where(~shows).withColumn("__stale", F.lit(False))
        if bound is not None:
            first = str(spark.range(1).select(F.to_date(bound)).first()[0])
            recent = fact.read([f"order_date={d}" for d in fact.partitions() if d >= first]).where(inside).select(*ORDER_COLUMNS)
            orders = orders.unionByName(recent.join(known.select("order_id"), "order_id", "left_anti"))
            stale = recent.select("order_id", F.lit(True).alias("__stale"))
            hidden = hidden.drop("__stale").join(stale, "order_id", "left")
        if bound is None:   # an empty fact takes orders of any age: there is nothing to narrow payments and customers to
            payments, customers = silver.stg_transactions(raw["raw_transactions"], as_of), fact_customers(raw["raw_customers"], as_of)
        else:
            payments = silver.stg_transactions_for_orders(raw["raw_transactions"], orders.select("order_id"), as_of)
            customers = customers_for(raw["raw_customers"], orders.select("customer_id"), as_of)
        # Those that may show later, and those whose row in the fact is no longer true but has no successor.
        waits = hidden.where((inside & F.col("order_timestamp").isNotNull()) | F.coalesce("__stale", F.lit(False)))
        rest = kept(waits.select(*known.columns), scratch_path(spark, "late-waiting"))
        fact.upsert(gold.fct_orders(orders, payments, customers, as_of), "order_id")
        waiting.write(rest)
        waiting.vacuum()
        for path in stages:
            delete(spark, path)

    return handle
