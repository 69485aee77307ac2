"""Plan regression tests: the physical properties the design relies on at scale."""

import re

import pytest
from conftest import SF_SMALL

from ferrolake.plans import pipeline


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # the shuffle plan used at scale
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dedup_limits_before_the_shuffle(spark):
    from ferrolake.plans.silver import dedup_orders
    from ferrolake.sources import derived
    text = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = dedup_orders(derived.raw_orders(spark, SF_SMALL))._jdf.queryExecution().explainString(text)
    tree = plan.split("\n\n")[0]
    # partial top-1 per key inside each map task, then the exchange, then the final top-1
    assert re.search(r"WindowGroupLimit.*\n.*Sort.*\n.*Exchange.*\n.*WindowGroupLimit", tree, re.S)


def test_fact_has_one_exchange_per_grain(no_broadcast):
    m = pipeline.models_from_tables(no_broadcast, SF_SMALL)
    plan = _plan(m["fct_orders"])
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(shuffles) == ["customer_id", "customer_id", "order_id", "order_id", "transaction_id"]


def test_mart_has_no_expand_and_reuses_partitioning(no_broadcast):
    m = pipeline.models_from_tables(no_broadcast, SF_SMALL)
    plan = _plan(m["mart_customer_lifetime"])
    assert "Expand" not in plan
    # the feature aggregate sits on the join's customer_id partitioning: partial and final
    # ObjectHashAggregate with no exchange between them
    assert re.search(r"ObjectHashAggregate\(keys=\[customer_id#\d+\].*\n\s*\+- ObjectHashAggregate", plan)


def test_scans_read_only_needed_columns(spark):
    m = pipeline.models_from_tables(spark, SF_SMALL)
    plan = _plan(m["stg_orders"])
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("o_orderpriority" not in s and "o_orderstatus" not in s for s in schemas)


def test_incremental_mart_prunes_fact_partitions(spark):
    from ferrolake.plans import gold
    from ferrolake.session import scratch_path
    from ferrolake.sources import derived
    root = scratch_path(spark, "t-plan")
    out = pipeline.run_full(spark, derived.bronze(spark, SF_SMALL, pipeline.PREV), pipeline.PREV, root)
    batch = gold.mart_customer_lifetime(out["dim_customers"], out["fct_orders"], pipeline.AS_OF,
                                        target=out["mart_customer_lifetime"])
    assert re.search(r"PartitionFilters: \[.*order_date#\d+ >= 2001-05-29", _plan(batch))


def test_fact_lookback_bound_reads_one_partition(spark):
    from pyspark.sql import functions as F

    from ferrolake.session import scratch_path
    from ferrolake.sources import derived
    root = scratch_path(spark, "t-bound")
    out = pipeline.run_full(spark, derived.bronze(spark, SF_SMALL, pipeline.PREV), pipeline.PREV, root)
    fast = pipeline.fact_lookback_bound(pipeline.fact_table(spark, root))
    slow = F.lit(out["fct_orders"].agg(F.max("order_timestamp")).first()[0]).cast("timestamp") - F.expr("INTERVAL 3 DAYS")
    a, b = spark.range(1).select(fast.alias("a"), slow.alias("b")).first()
    assert a == b
