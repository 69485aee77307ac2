"""Hash-bucketed tables and the kept winners of the Bronze feeds."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ferrolake.operators.bucketed import BucketedTable, newer
from ferrolake.plans import silver
from ferrolake.plans.winners import Winners
from ferrolake.session import scratch_path
from helpers import customers, orders

SCHEMA = "k string, v int, s string"


def _table(spark, name, buckets=4, rows=40):
    t = BucketedTable(spark, scratch_path(spark, name), "k", buckets)
    t.write(spark.range(rows).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit("x").alias("s")))
    return t


def _rows(t):
    return sorted(map(tuple, t.read().collect()), key=str)


def test_upsert_rewrites_touched_buckets_only(spark):
    t = _table(spark, "b-touch", buckets=16, rows=400)
    before = t.current()
    touched = t.upsert(spark.createDataFrame([("7", 2, "new"), ("nope", 3, None)], SCHEMA))
    after = t.current()
    assert 1 <= len(touched) <= 2 and {d for d in after if after[d] != before.get(d)} == set(touched)
    assert t.read().count() == 401 and sorted(r.v for r in t.read().where("v > 1").collect()) == [2, 3]
    t.upsert(spark.createDataFrame([("7", 2, "new"), ("nope", 3, None)], SCHEMA))   # again: the same rows
    assert t.read().count() == 401
    t.upsert(spark.createDataFrame([], SCHEMA))
    t.vacuum(keep=1)
    assert t.read().count() == 401 and len(t.manifests()) == 1
    t.upsert(spark.createDataFrame([("7", 5, "newer")], SCHEMA))   # after a vacuum the table is registered anew
    assert t.read().where("k = '7'").collect()[0].v == 5


def test_null_keys_are_one_key(spark):
    t = _table(spark, "b-null", rows=3)
    for v in (8, 9):
        t.upsert(spark.createDataFrame([(None, v, None), ("-", v, None), ("=", v, None)], SCHEMA))
    got = [r for r in _rows(t) if r[1] > 1]
    assert sorted(got, key=str) == sorted([(None, 9, None), ("-", 9, None), ("=", 9, None)], key=str)


@pytest.mark.parametrize("shuffle", ["4", "32"])
def test_stored_side_of_the_merge_has_no_exchange(spark, shuffle):
    t = _table(spark, f"b-plan-{shuffle}", buckets=8)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    try:
        batch = t._placed(spark.createDataFrame([("1", 2, "n")], SCHEMA))
        plan = t.merged(batch, [0, 1, 2], newer([("v", "desc")]))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert re.search(r"PartitionFilters: \[bucket_no#\d+ IN \(0,1,2\)\]", plan)
    left = plan[plan.index("SortMergeJoin"):plan.index("FileScan")]
    assert "Exchange" not in left   # the stored rows stay where they are


def test_interrupted_upsert_leaves_the_table_as_it_was(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    batch = spark.createDataFrame([("1", 2, "n"), ("new", 2, "n")], SCHEMA)
    for step in (1, 2, 3):   # stage, buckets, manifest
        t = _table(spark, f"b-broken-{step}")
        want = _rows(t)
        with monkeypatch.context() as m:
            seen = []
            for name in ("parquet", "saveAsTable"):
                def call(self, path, *a, real=getattr(DataFrameWriter, name), **k):
                    seen.append(path)
                    if len(seen) == step:
                        raise RuntimeError("lost driver")
                    return real(self, path, *a, **k)
                m.setattr(DataFrameWriter, name, call)
            with pytest.raises(RuntimeError):
                t.upsert(batch)
        assert _rows(t) == want
        t.upsert(batch)
        assert len(_rows(t)) == len(want) + 1


def test_order_of_versions_is_that_of_the_full_dedup(spark):
    """All pairs of rows: ``newer`` picks the row that ``keep_latest`` picks."""
    from ferrolake.operators.dedup import keep_latest
    values = [(a, b, c) for a in (None, 1, 2) for b in (None, "x", "y") for c in (None, "p", "q")]
    rows = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, a int, b string, c string")
    pairs = rows.alias("m").crossJoin(rows.alias("n")).where("m.i <> n.i")
    fast = pairs.select("m.i", "n.i", newer([("a", "desc"), ("b", "asc"), ("c", "asc")])("n", "m").alias("w"))
    got = {(r[0], r[1]): r[2] for r in fast.collect()}
    both = pairs.select(F.concat_ws("-", "m.i", "n.i").alias("k"), F.explode(F.array(F.struct("m.*"), F.struct("n.*"))).alias("r")).select("k", "r.a", "r.b", "r.c", F.col("r.i"))
    best = keep_latest(both, "k", [F.col("a").desc_nulls_last(), F.col("b").asc_nulls_first(), F.col("c").asc_nulls_first()])
    want = {tuple(map(int, r.k.split("-"))): r.i for r in best.collect()}
    assert all(got[m, n] == (want[m, n] == n) for m, n in got)


def _events(rng, n, t0=0):
    when = lambda d: f"2001-01-{1 + d % 28:02d} {d % 24:02d}:00:00"
    return [(rng.choice([None, *range(12)]), rng.randrange(3), rng.choice(["a", "b", None]), rng.randrange(5), when(rng.randrange(28)),
             when(t0 + rng.randrange(28)), rng.choice(["f1", "f2", None])) for _ in range(n)]


def test_batches_in_any_order_equal_the_full_dedup(spark):
    rng = random.Random(11)
    batches = [orders(spark, _events(rng, 40)) for _ in range(4)]
    kept = Winners(spark, scratch_path(spark, "w-any"), "raw_orders")
    kept.rebuild(batches[0])
    seen = batches[0]
    for b in batches[1:]:   # ingestion times overlap: many rows arrive later than newer ones
        kept.apply(b)
        seen = seen.unionByName(b)
    want = sorted(map(str, silver.dedup_orders(seen).collect()))
    assert sorted(map(str, kept.read().collect())) == want
    now = kept.table.read().count()
    kept.apply(batches[2])   # a batch that comes twice
    assert sorted(map(str, kept.read().collect())) == want and kept.table.read().count() == now


def test_new_rows_are_found_by_ingestion_time(spark):
    at = "2001-01-10 00:00:00"
    cust = lambda i, ingest: (i, "a", "b", "c@d.eu", "de", "standard", at, at, ingest)
    kept = Winners(spark, scratch_path(spark, "w-mark"), "raw_customers")
    first = customers(spark, [cust(1, "2001-01-10 00:00:00"), cust(2, "2001-01-01 00:00:00")])
    assert kept.mark() is None and kept.new_rows(first).count() == 2
    kept.rebuild(first)
    more = first.unionByName(customers(spark, [cust(3, "2001-01-09 12:00:00"), cust(4, "2001-01-11 00:00:00"), cust(5, "2001-01-02 00:00:00")]))
    assert sorted(r.customer_id for r in kept.new_rows(more).collect()) == [1, 3, 4]   # within the overlap, too


def test_incremental_run_deduplicates_the_batch_only(spark):
    """The Silver views of a later run hold no window; they read stored winners."""
    from conftest import SF_SMALL
    from ferrolake.plans import pipeline, winners
    from ferrolake.sources import derived
    root = scratch_path(spark, "w-plan")
    winners.advance(spark, root, derived.bronze(spark, SF_SMALL, pipeline.PREV))
    views = silver.views(winners.advance(spark, root, derived.bronze(spark, SF_SMALL)), pipeline.AS_OF)
    full = pipeline.models_from_tables(spark, SF_SMALL)
    for name, df in views.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Exchange" not in plan
        assert sorted(map(str, df.collect())) == sorted(map(str, full[name].collect()))


def test_rebuild_moves_rows_once(spark, monkeypatch):
    """The first write of winners has one exchange, keeps a NULL key and the columns in their order."""
    import datetime as dt

    from ferrolake.sources.bronze import RAW_ORDERS_SCHEMA
    at = [dt.datetime(2000, 1, d) for d in (1, 2, 3)]
    rows = [(i, 7, "pending", None, at[0], at[k], "f") for i in (1, 2, None) for k in (1, 2)] + [(3, None, "-", None, None, None, None)]
    raw = spark.createDataFrame(rows, RAW_ORDERS_SCHEMA)
    kept, plans = Winners(spark, scratch_path(spark, "t-once"), "raw_orders"), []
    write = type(kept.table).write
    monkeypatch.setattr(type(kept.table), "write", lambda self, df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(self, df, *a)))
    kept.rebuild(raw)
    assert plans[0].count("Exchange") == 1 and plans[0].count("WindowGroupLimit") == 2
    want = silver.dedup("raw_orders", raw)
    assert kept.read().columns == want.columns
    assert sorted(map(str, kept.read().collect())) == sorted(map(str, want.collect())) and kept.read().count() == 4


def test_incremental_batch_is_stored(spark):
    """What the caller sees of the fact's batch is read from files, not worked out again."""
    from ferrolake.plans import pipeline
    df = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count()
    kept = pipeline._staged(spark, df, "t-staged")
    assert kept.dtypes == df.dtypes and "Aggregate" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(kept.collect()) == sorted(df.collect())
