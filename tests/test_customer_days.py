"""Kept (customer, day) totals against features worked out from the fact."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ferrolake.operators.upsert import PartitionedTable
from ferrolake.plans import gold
from ferrolake.plans.customer_days import CustomerDays, features_as_of
from ferrolake.session import scratch_path

SCHEMA = "order_id string, customer_id string, order_date date, net_revenue_eur decimal(38,2), is_fulfilled boolean"


def _orders(spark, rng, ids):
    day = lambda: dt.date(2001, 6, 1) + dt.timedelta(days=rng.randrange(12) * 30)
    rows = [(str(i), rng.choice(["a", "a", "b", "c", None]), day(), Decimal(rng.randrange(10000)) / 100, rng.random() < 0.8) for i in ids]
    return spark.createDataFrame(rows, SCHEMA)


def _want(fct, as_of):
    more = {"primary_payment_method": F.lit("x"), "order_size_band": F.lit("x"), "has_chargeback": F.lit(False),
            "refunded_amount_eur": F.lit(0), "order_timestamp": F.col("order_date").cast("timestamp")}
    f = gold.customer_features(fct.where(F.col("order_date") <= F.lit(as_of[:10]).cast("date")).withColumns(more), as_of)
    cols = ["customer_id", *[f"orders_last_{n}d" for n in (7, 30, 90, 365)], *[f"revenue_last_{n}d" for n in (30, 90, 365)]]
    return sorted((tuple(r) for r in f.select(*cols).collect()), key=str)


def test_totals_follow_the_fact(spark, monkeypatch):
    rng = random.Random(8)
    root = scratch_path(spark, "d-root")
    fact, days = PartitionedTable(spark, f"{root}/fct", "order_date"), CustomerDays(spark, root)
    fact.write(_orders(spark, rng, range(60)))
    assert days.advance(fact)   # never built: from the whole fact
    for ids in (range(50, 70), [3, 4]):   # moved days, other customers, orders no longer fulfilled, new ones
        fact.upsert(_orders(spark, rng, ids), "order_id")
        read, real = [], PartitionedTable._rows

        def rows(self, now, only=None, real=real, read=read):
            if self is fact:
                read.append(only)
            return real(self, now, only)
        monkeypatch.setattr(PartitionedTable, "_rows", rows)
        days.advance(fact)
        monkeypatch.undo()
        assert read and all(only is not None and len(only) <= 2 * len(ids) for only in read)   # the touched days only
        for as_of in ("2002-05-01 00:00:00", "2001-09-15 10:00:00", "2001-01-01 00:00:00"):
            got = features_as_of(days.table.read(), as_of)
            assert sorted((tuple(r) for r in got.collect()), key=str) == _want(fact.read(), as_of)
    assert days.advance(fact) == []


def test_a_run_that_dies_is_caught_up(spark, monkeypatch):
    rng = random.Random(9)
    root = scratch_path(spark, "d-dies")
    fact, days = PartitionedTable(spark, f"{root}/fct", "order_date"), CustomerDays(spark, root)
    fact.write(_orders(spark, rng, range(20)))
    days.advance(fact)
    fact.upsert(_orders(spark, rng, [1, 2]), "order_id")
    monkeypatch.setattr(days, "_note", lambda m: (_ for _ in ()).throw(RuntimeError("lost driver")))
    try:
        days.advance(fact)
    except RuntimeError:
        pass
    monkeypatch.undo()
    fact.upsert(_orders(spark, rng, [3]), "order_id")
    days.advance(fact)
    as_of = "2002-05-01 00:00:00"
    assert sorted((tuple(r) for r in features_as_of(days.table.read(), as_of).collect()), key=str) == _want(fact.read(), as_of)


def test_as_of_query_leaves_out_the_dimension(spark, monkeypatch):
    """The fact's columns that the look-back totals need come from orders and payments: no join moves the orders to customers."""
    from ferrolake.operators.upsert import PartitionedTable
    from ferrolake.plans import catalog

    class Stop(Exception):
        pass

    def stop(table, df, *a):
        raise Stop(df._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(PartitionedTable, "write", stop)
    with pytest.raises(Stop) as plan:
        catalog.QUERIES["agg_windowed_as_of"](spark, SF_SMALL)
    assert "l_orderkey" in str(plan.value) and "c_custkey" not in str(plan.value)
