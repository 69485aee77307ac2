"""The newest version per key as streaming state, and the look-back upsert that it feeds."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrolake.operators.upsert import PartitionedTable, VersionedTable
from ferrolake.plans import silver
from ferrolake.session import scratch_path
from ferrolake.sources.bronze import RAW_ORDERS_SCHEMA
from ferrolake.streaming.ingest import landing_stream
from ferrolake.streaming.late_data import changed_winners, fact_upsert_handler, inverted, run_changes
from helpers import customer, customers, orders, payments
from test_winners import _events


def test_inverted_reverses_every_order(spark):
    words = [None, "", "a", "ab", "abc", "b", "Z", "é", "éa", "\U0001f600", "zz"]
    numbers = [None, -5, 0, 3, 10**12]
    for values, dtype in ((words, T.StringType()), (numbers, T.LongType())):
        df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))
        up = [r.v for r in df.orderBy(F.col("v").asc_nulls_first()).collect()]
        assert [r.v for r in df.orderBy(inverted(F.col("v"), dtype).desc()).collect()] == up


def test_only_changed_winners_are_emitted(spark):
    landing, ckpt = scratch_path(spark, "l-land"), scratch_path(spark, "l-ckpt")
    row = lambda k, amount, ingest: (k, 1, "DELIVERED", amount, "2001-01-01 00:00:00", ingest, "f")
    batches = [[row(1, 10, "2001-01-05 00:00:00"), row(1, 11, "2001-01-04 00:00:00"), row(2, 20, "2001-01-05 00:00:00")],
               [row(1, 12, "2001-01-03 00:00:00"), row(2, 20, "2001-01-05 00:00:00")],      # late and older; sent again
               [row(2, 21, "2001-01-06 00:00:00"), row(1, 9, "2001-01-05 00:00:00"), row(None, 5, "2001-01-06 00:00:00")]]
    got = []
    for b in batches:
        orders(spark, b).write.mode("append").parquet(landing)
        out = []
        run_changes(landing_stream(spark, landing, RAW_ORDERS_SCHEMA), "raw_orders", ckpt,
                    lambda df, i, out=out: out.extend((r.order_id, int(r.order_amount_eur)) for r in df.collect()))
        got.append(sorted(out, key=str))
    # of equal ingestion times the tie-break of the full dedup decides: the smaller amount
    assert got == [[("1", 10), ("2", 20)], [], [("1", 9), ("2", 21), (None, 5)]]


def test_state_equals_the_full_dedup(spark):
    rng = random.Random(3)
    landing, ckpt = scratch_path(spark, "l-any"), scratch_path(spark, "l-anyc")
    seen, last = None, {}
    for _ in range(3):
        b = orders(spark, _events(rng, 50))
        b.write.mode("append").parquet(landing)
        seen = b if seen is None else seen.unionByName(b)
        run_changes(landing_stream(spark, landing, RAW_ORDERS_SCHEMA), "raw_orders", ckpt,
                    lambda df, i: last.update({r.order_id: str(r) for r in df.collect()}))
        assert sorted(last.values()) == sorted(map(str, silver.dedup_orders(seen).collect()))


def test_stateful_plan_reads_no_bronze_again(spark):
    landing = scratch_path(spark, "l-plan")
    orders(spark, [(1, 1, "DELIVERED", 1, "2001-01-01 00:00:00", "2001-01-01 00:00:00", "f")]).write.parquet(landing)
    df = changed_winners(landing_stream(spark, landing, RAW_ORDERS_SCHEMA), "raw_orders")
    plan = df._jdf.queryExecution().analyzed().toString()
    assert df.isStreaming and "Window" not in plan and "Python" not in plan


def _run(spark, fact, waiting, changed, as_of, pays=()):
    cust = customers(spark, [customer(1), customer(2)])
    handler = fact_upsert_handler(spark, fact, waiting, lambda: {"raw_customers": cust, "raw_transactions": payments(spark, list(pays))}, lambda: as_of)
    handler(silver.keyed("raw_orders", orders(spark, changed)), 0)
    return {r.order_id: (int(r.order_amount_eur), int(r.paid_amount_eur), str(r._dbt_loaded_at)[:10]) for r in fact.read().collect()}


def test_window_is_rebuilt_and_hidden_orders_wait(spark):
    fact = PartitionedTable(spark, scratch_path(spark, "l-fact"), "order_date")
    waiting = VersionedTable(spark, scratch_path(spark, "l-wait"))
    o = lambda k, amount, at, status="DELIVERED": (k, 1, status, amount, f"{at} 00:00:00", f"{at} 06:00:00", "f")
    first = [o(1, 10, "2001-06-01"), o(2, 20, "2001-06-09"), o(3, 30, "2001-06-10"), o(4, 40, "2001-06-20"), o(5, 50, "2001-06-10", "TEST")]
    got = _run(spark, fact, waiting, first, "2001-06-11 00:00:00")
    assert got == {"1": (10, 0, "2001-06-11"), "2": (20, 0, "2001-06-11"), "3": (30, 0, "2001-06-11")}
    # Next run: one change, one order that is no longer shown, one too late; a payment arrives for an unchanged order.
    later = [o(2, 21, "2001-06-09"), o(3, 30, "2001-06-10", "TEST"), o(6, 60, "2001-06-02")]
    pays = [(1, 2, "CARD", 7, "COMPLETED", "2001-06-10 00:00:00", "2001-06-10 00:00:00"),
            (2, 1, "CARD", 9, "COMPLETED", "2001-06-10 00:00:00", "2001-06-10 00:00:00")]
    want = {"1": (10, 0, "2001-06-11"), "2": (21, 7, "2001-06-21"), "3": (30, 0, "2001-06-11"), "4": (40, 0, "2001-06-21")}
    assert _run(spark, fact, waiting, later, "2001-06-21 00:00:00", pays) == want
    assert sorted(r.order_id for r in waiting.read().collect()) == ["3", "5"]
    assert _run(spark, fact, waiting, later, "2001-06-21 00:00:00", pays) == want   # a retried batch changes nothing


def test_first_run_narrows_and_moves_nothing_twice(spark, monkeypatch):
    """An empty fact takes all orders: payments and customers are not semi-joined, the batch is stored once by the write, and
    what waits is told by a filter. A NULL key still waits, as it never reaches the fact."""
    from ferrolake.operators import upsert
    from ferrolake.streaming import late_data
    staged, plans = [], []
    path = upsert.scratch_path
    monkeypatch.setattr(upsert, "scratch_path", lambda s, name: staged.append(name) or path(s, name))
    write = VersionedTable.write
    monkeypatch.setattr(VersionedTable, "write", lambda t, df, *a: plans.append(df._jdf.queryExecution().toString()) or write(t, df, *a))
    refuse = lambda *a: (_ for _ in ()).throw(AssertionError("narrowed"))
    fact = PartitionedTable(spark, scratch_path(spark, "l-one"), "order_date")
    waiting = VersionedTable(spark, scratch_path(spark, "l-onew"))
    o = lambda k, status="DELIVERED", at="2001-06-01": (k, 1, status, 10, f"{at} 00:00:00", f"{at} 06:00:00", "f")
    with monkeypatch.context() as m:
        m.setattr(late_data.silver, "stg_transactions_for_orders", refuse)
        m.setattr(late_data, "customers_for", refuse)
        got = _run(spark, fact, waiting, [o(1), o(2, "TEST"), o(3, at="2001-07-01"), o(None), o(4, None)], "2001-06-11 00:00:00")
    assert got == {"1": (10, 0, "2001-06-11")} and "upsert-stage" not in staged
    assert {r.order_id for r in waiting.read().collect()} == {"2", "3", None, "4"}
    assert not any("Join" in p for p in plans)
