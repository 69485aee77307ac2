"""Bronze feeds derived from the driver's star-schema tables (orders, customer, lineitem).

These are the inputs the whole pipeline is tested and benchmarked on: order events with re-sent
versions, test records and padded mixed-case values; two CRM snapshots plus customers without
orders; payment events with duplicate keys and planted zero amounts. Every row is a deterministic
function of the driver's rows, so the work grows with the tables.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bronze import RAW_CUSTOMERS_SCHEMA, RAW_ORDERS_SCHEMA, RAW_TRANSACTIONS_SCHEMA, conform, ingested_until




def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(c: str):
    return F.col(c).cast("timestamp")


def raw_orders(spark: SparkSession, sf_dir: str, cutoff=None) -> DataFrame:
    """Order events: version 1 of every order, version 2 ('delivered', full amount) of every tenth."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    status = (F.when(k % 20 == 13, "test").when(k % 20 == 17, "Refunded")
              .when(k % 7 == 0, " pending").when(k % 7 == 1, "Confirmed")
              .when(k % 7 == 2, "shipped ").when(k % 7 == 3, "cancelled").otherwise("DELIVERED"))
    divisor = (F.when(k % 4 == 0, 20000).when(k % 4 == 1, 1000).when(k % 4 == 2, 100).otherwise(1))
    cents = F.round(F.col("o_totalprice") * 100)
    hundredth = F.lit(Decimal("0.01")).cast("decimal(3,2)")
    v1 = o.select(
        k.alias("order_id"), F.col("o_custkey").alias("customer_id"), status.alias("order_status"),
        (F.floor(cents / divisor).cast("bigint").cast("decimal(18,2)") * hundredth).alias("order_amount_eur"),
        _ts("o_orderdate").alias("order_timestamp"),
        (_ts("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("_ingestion_timestamp"),
        F.lit("orders/v1").alias("_source_file"))
    v2 = o.where(k % 10 == 0).select(
        k.alias("order_id"), F.col("o_custkey").alias("customer_id"), F.lit("delivered").alias("order_status"),
        (cents.cast("bigint").cast("decimal(18,2)") * hundredth).alias("order_amount_eur"),
        _ts("o_orderdate").alias("order_timestamp"),
        (_ts("o_orderdate") + F.expr("INTERVAL 5 DAYS")).alias("_ingestion_timestamp"),
        F.lit("orders/v2").alias("_source_file"))
    return ingested_until(conform(v1.unionByName(v2), RAW_ORDERS_SCHEMA), cutoff)


def raw_customers(spark: SparkSession, sf_dir: str, cutoff=None) -> DataFrame:
    """CRM snapshots: the old one, a newer one renaming every 15th customer, and order-less customers."""
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    key = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    country = (F.when(F.col("c_nationkey") % 5 == 0, "de ").when(F.col("c_nationkey") % 5 == 1, "FR")
               .when(F.col("c_nationkey") % 5 == 2, " nl").when(F.col("c_nationkey") % 5 == 3, "Be")
               .otherwise("es"))
    segment = (F.when(seg == "BUILDING", "PREMIUM ").when(seg == "FURNITURE", "wholesale")
               .when(seg == "HOUSEHOLD", "Internal").otherwise(" standard"))

    def ts(s: str):
        return F.lit(s).cast("timestamp")

    old = c.select(
        key.alias("customer_id"), F.concat(F.lit(" "), F.lower(seg)).alias("first_name"),
        F.concat(F.upper("c_name"), F.lit(" ")).alias("last_name"),
        F.concat(F.lit(" User"), key.cast("string"), F.lit("@Example.COM ")).alias("email"),
        country.alias("country_code"), segment.alias("customer_segment"),
        ts("1994-01-01 00:00:00").alias("created_at"), ts("1994-06-01 00:00:00").alias("updated_at"),
        ts("1994-06-02 00:00:00").alias("_ingestion_timestamp"))
    renamed = c.where(key % 15 == 0).select(
        key.alias("customer_id"), F.lit("anna").alias("first_name"), F.lit("novak").alias("last_name"),
        F.concat(F.lit("anna"), key.cast("string"), F.lit("@example.org")).alias("email"),
        F.lit("nl").alias("country_code"), F.lit("premium").alias("customer_segment"),
        ts("1994-01-01 00:00:00").alias("created_at"), ts("1999-06-01 00:00:00").alias("updated_at"),
        ts("1999-06-02 00:00:00").alias("_ingestion_timestamp"))
    new = c.where(key % 50 == 0).select(
        (key + 10000000).alias("customer_id"), F.lit("new").alias("first_name"), F.lit("buyer").alias("last_name"),
        F.concat(F.lit("new"), key.cast("string"), F.lit("@example.org")).alias("email"),
        F.lit("fr").alias("country_code"), F.lit("standard").alias("customer_segment"),
        ts("2001-01-01 00:00:00").alias("created_at"), ts("2001-01-01 00:00:00").alias("updated_at"),
        ts("2001-01-02 00:00:00").alias("_ingestion_timestamp"))
    return ingested_until(conform(old.unionByName(renamed).unionByName(new), RAW_CUSTOMERS_SCHEMA), cutoff)


def raw_transactions(spark: SparkSession, sf_dir: str, cutoff=None) -> DataFrame:
    """Payment events, one per line item; repeated (order, line) pairs are natural duplicates."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    line = F.col("l_linenumber")
    method = (F.when(line == 1, "card").when(line == 2, " Bank_Transfer").when(line == 3, "APPLE_PAY")
              .when(line == 4, "google_pay ").when(line == 5, "voucher").otherwise("CRYPTO"))
    supp = F.col("l_suppkey") % 50
    status = (F.when(supp == 0, "chargeback").when(supp == 1, " failed")
              .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "Refunded")
              .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), "pending")
              .otherwise("completed"))
    amount = (F.when(F.col("l_partkey") % 40 == 0, F.lit(0).cast("decimal(18,2)"))
              .otherwise(F.col("l_extendedprice").cast("decimal(18,2)")))
    out = li.select(
        (F.col("l_orderkey") * 10 + line).alias("transaction_id"), F.col("l_orderkey").alias("order_id"),
        method.alias("payment_method"), amount.alias("transaction_amount_eur"), status.alias("transaction_status"),
        _ts("l_shipdate").alias("transaction_timestamp"),
        (_ts("l_shipdate") + F.expr("INTERVAL 1 HOUR")).alias("_ingestion_timestamp"))
    return ingested_until(conform(out, RAW_TRANSACTIONS_SCHEMA), cutoff)


def bronze(spark: SparkSession, sf_dir: str, cutoff=None) -> dict[str, DataFrame]:
    return {
        "raw_orders": raw_orders(spark, sf_dir, cutoff),
        "raw_customers": raw_customers(spark, sf_dir, cutoff),
        "raw_transactions": raw_transactions(spark, sf_dir, cutoff),
    }


MANIFEST_NODES = 8


def run_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run manifests (JSON lines) per order: a model node per line item, chained by line number
    and rooted in a source node; documented columns and a tag come from the item's values. Every
    project (order) ran twice; the first item of every fifth needs a model that no manifest describes.

    Each manifest holds at most ``MANIFEST_NODES`` line items of one order (an order with more lines
    gets several manifests), so no group grows with the data; dependencies between manifests
    resolve in the global id join of the lineage tables.
    """
    li = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_quantity").alias("q"), F.min("l_linestatus").alias("st"), F.min("l_returnflag").alias("rf"))
    k = F.col("l_orderkey")
    proj = F.concat(F.lit("p"), k.cast("string"))
    source_id = F.concat(F.lit("source."), proj, F.lit(".raw_orders"))
    gone = F.concat(F.lit("model.other.z_"), k.cast("string"))
    null_s = F.lit(None).cast("string")

    def model_id(line: Column) -> Column:
        return F.concat(F.lit("model."), proj, F.lit(".line_"), line.cast("string"))

    def node(item: Column) -> Column:
        ln = item["ln"]
        dep = F.when((ln == 1) & (k % 5 == 0), gone).when(ln == 1, source_id).otherwise(model_id(ln - 1))
        return F.struct(
            F.lit("model").alias("resource_type"),
            F.concat(F.lit("line_"), ln.cast("string")).alias("name"),
            F.when(ln % 2 == 1, "gold").otherwise("silver").alias("schema"),
            F.when(k % 3 == 0, null_s).otherwise(F.lit("lake")).alias("database"),
            F.struct(F.array(dep).alias("nodes")).alias("depends_on"),
            F.create_map(
                F.lit("quantity"), F.struct(F.concat(F.lit("qty "), item["q"].cast("bigint").cast("string")).alias("description"),
                                            F.lit("decimal(18,2)").alias("data_type")),
                F.lit("status"), F.struct(item["st"].alias("description"), null_s.alias("data_type"))).alias("columns"),
            F.array(item["rf"]).alias("tags"),
            F.when(ln % 2 == 1, F.concat(F.lit("line "), ln.cast("string"))).alias("description"))

    source_node = F.struct(
        F.lit("source").alias("resource_type"), F.lit("raw_orders").alias("name"), F.lit("bronze").alias("schema"),
        null_s.alias("database"), F.struct(F.array().cast("array<string>").alias("nodes")).alias("depends_on"),
        F.create_map().cast("map<string,struct<description:string,data_type:string>>").alias("columns"),
        F.array().cast("array<string>").alias("tags"), null_s.alias("description"))
    # Bare items are collected and become nodes afterwards: the shuffle carries numbers and letters, not documents.
    chunk = F.floor((F.col("l_linenumber") - 1) / MANIFEST_NODES).alias("chunk")
    per_chunk = (li.groupBy("l_orderkey", chunk)
                 .agg(F.collect_list(F.struct(F.col("l_linenumber").alias("ln"), "q", "st", "rf")).alias("items")))
    m = F.map_from_entries(F.transform("items", lambda i: F.struct(model_id(i["ln"]).alias("k"), node(i).alias("v"))))
    nodes = F.when(F.col("chunk") == 0, F.map_concat(m, F.create_map(source_id, source_node))).otherwise(m)
    # Both runs of a project have the same nodes: written as JSON once, by a generator whose output is a column of its own.
    bodies = per_chunk.select("l_orderkey", F.explode_outer(F.array(F.to_json(nodes))).alias("body"))
    runs = bodies.withColumn("run", F.explode(F.array(F.lit(1), F.lit(2))))
    run_id = F.concat(F.lit("run-"), k.cast("string"), F.lit("-"), F.col("run").cast("string"))
    head = F.to_json(F.struct(F.struct(run_id.alias("invocation_id")).alias("metadata")))
    return runs.select(F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"nodes":'), "body", F.lit("}")).alias("value"))
