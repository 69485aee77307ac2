import datetime as dt

from pyspark.sql import functions as F

from ferrolake.operators.upsert import PartitionedTable, VersionedTable, merge
from ferrolake.session import scratch_path


def _fact(spark, rows):
    return spark.createDataFrame([(k, dt.date.fromisoformat(d), v) for k, d, v in rows],
                                 "order_id string, order_date date, v int")


def _rows(df):
    return sorted((r.order_id, str(r.order_date), r.v) for r in df.collect())


def test_merge_replaces_inserts_and_is_idempotent(spark):
    t = _fact(spark, [("a", "2001-01-01", 1), ("b", "2001-01-01", 1)])
    s = _fact(spark, [("b", "2001-01-02", 2), ("c", "2001-01-03", 3), (None, "2001-01-03", 9)])
    once = merge(t, s, "order_id")
    assert _rows(once) == [("a", "2001-01-01", 1), ("b", "2001-01-02", 2), ("c", "2001-01-03", 3)]
    assert _rows(merge(once, s, "order_id")) == _rows(once)


def _fact_table(spark, name):
    return PartitionedTable(spark, scratch_path(spark, name), "order_date", cluster=["order_id"])


def test_partition_upsert_moves_a_key_and_drops_emptied_partition(spark):
    fact = _fact_table(spark, "t-fact")
    fact.upsert(_fact(spark, [("a", "2001-01-01", 1), ("b", "2001-01-05", 1)]), "order_id")
    src = _fact(spark, [("a", "2001-01-02", 2), (None, "2001-01-07", 9)])
    assert sorted(fact.upsert(src, "order_id")) == ["order_date=2001-01-01", "order_date=2001-01-02"]
    got = _rows(fact.read())
    assert got == [("a", "2001-01-02", 2), ("b", "2001-01-05", 1)]
    fact.upsert(src, "order_id")   # repeated: unchanged
    assert _rows(fact.read()) == got and fact.partitions() == ["2001-01-02", "2001-01-05"]
    fact.vacuum(keep=1)
    assert _rows(fact.read()) == got and len(fact.manifests()) == 1


def _fail_at(monkeypatch, step):
    """Make the n-th write of an upsert fail: stage, rows to be laid out, data, manifest."""
    from pyspark.sql.readwriter import DataFrameWriter
    real, seen = DataFrameWriter.parquet, []

    def parquet(self, path, *a, **k):
        seen.append(path)
        if len(seen) == step:
            raise RuntimeError("lost driver")
        return real(self, path, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def test_interrupted_upsert_changes_nothing_and_reruns(spark, monkeypatch):
    import pytest
    start = [("a", "2001-01-01", 1), ("b", "2001-01-01", 1), ("c", "2001-01-20", 1)]
    batch = _fact(spark, [("a", "2001-01-04", 2), ("d", "2001-01-12", 2), ("c", "2001-01-20", 2)])
    want = [("a", "2001-01-04", 2), ("b", "2001-01-01", 1), ("c", "2001-01-20", 2), ("d", "2001-01-12", 2)]
    for step in (1, 2, 3, 4):
        fact = _fact_table(spark, f"t-broken-{step}")
        fact.write(_fact(spark, start))
        with monkeypatch.context() as m:
            _fail_at(m, step)
            with pytest.raises(RuntimeError):
                fact.upsert(batch, "order_id")
        assert _rows(fact.read()) == start and fact.partitions()[-1] == "2001-01-20"
        fact.upsert(batch, "order_id")
        assert _rows(fact.read()) == want
    with monkeypatch.context() as m:   # a full rewrite that dies before its manifest
        _fail_at(m, 3)
        with pytest.raises(RuntimeError):
            fact.write(_fact(spark, start))
    assert _rows(fact.read()) == want


def test_upsert_evaluates_its_source_once(spark):
    fact = _fact_table(spark, "t-once")
    fact.write(_fact(spark, [("a", "2001-01-01", 1)]))
    seen = spark.sparkContext.accumulator(0)

    def count(parts):
        for p in parts:
            seen.add(len(p))
            yield p
    src = _fact(spark, [("a", "2001-01-02", 2), ("b", "2001-01-03", 2)])
    fact.upsert(src.mapInPandas(count, src.schema), "order_id")
    assert seen.value == 2


def test_clustered_writes_work_out_their_input_once(spark):
    from ferrolake.operators.layout import clustered_write, partitioned_write
    rows = spark.range(60).selectExpr("cast(id % 7 as string) a", "cast(id as int) b", "date'2001-01-01' + cast(id % 3 as int) d")
    for write in (lambda df, p: clustered_write(df, p, ["a", "b"]), lambda df, p: clustered_write(df, p, ["a"]),
                  lambda df, p: partitioned_write(df, p, "d"), lambda df, p: partitioned_write(df, p, "d", cluster=["a", "b"])):
        seen = spark.sparkContext.accumulator(0)

        def count(parts):
            for p in parts:
                seen.add(len(p))
                yield p
        path = scratch_path(spark, "t-eval")
        write(rows.mapInPandas(count, rows.schema), path)
        assert seen.value == 60 and spark.read.parquet(path).count() == 60


def test_versioned_table_upsert_and_full_mode(spark):
    table = VersionedTable(spark, scratch_path(spark, "t-mart"))
    assert table.read() is None
    table.upsert(_fact(spark, [("a", "2001-01-01", 1)]), "order_id")           # empty target: full mode
    table.upsert(_fact(spark, [("a", "2001-01-01", 5), ("z", "2001-01-01", 1)]), "order_id")
    assert _rows(table.read()) == [("a", "2001-01-01", 5), ("z", "2001-01-01", 1)]
    assert len(table.versions()) == 2


def test_incremental_equals_full_from_empty_target(spark):
    from conftest import SF_SMALL
    from ferrolake.plans import pipeline
    from ferrolake.sources import derived
    root = scratch_path(spark, "t-lake")
    run = pipeline.run_incremental(spark, derived.bronze(spark, SF_SMALL), pipeline.AS_OF, root)
    full = pipeline.models_from_tables(spark, SF_SMALL)
    cols = ["order_id", "net_revenue_eur", "customer_sk"]
    assert sorted(run.tables["fct_orders"].select(*cols).collect()) == sorted(full["fct_orders"].select(*cols).collect())


def test_layout_and_column_stats(spark):
    from ferrolake.operators.layout import column_stats, layout_by
    df = spark.range(1000).select((F.col("id") % 37).alias("a"), (F.col("id") % 5).cast("string").alias("b"))
    out = layout_by(df, ["a", "b"], num_partitions=4)
    assert out.count() == 1000 and out.rdd.getNumPartitions() == 4
    st = {r.column_name: r for r in column_stats(df).collect()}
    assert st["b"].max_length == 1 and st["a"].row_count == 1000 and st["a"].null_count == 0


def test_daily_run_stops_on_stale_source_then_runs(spark):
    import pytest
    from conftest import SF_SMALL
    from ferrolake.plans import daily, pipeline
    from ferrolake.sources import derived
    root = scratch_path(spark, "t-daily")
    with pytest.raises(daily.StaleSourceError):   # customers were last loaded months before as_of
        daily.run_daily(spark, derived.bronze(spark, SF_SMALL, pipeline.AS_OF), pipeline.AS_OF, root)
    # sf0.01 has orders and shipments every day, so all three feeds are within the error threshold.
    fresh_bronze = derived.bronze(spark, "/root/testdata/sf0.01", "2001-01-02 12:00:00")
    manifests = scratch_path(spark, "t-manifests")
    derived.run_manifests(spark, SF_SMALL).limit(40).write.text(manifests)
    res = daily.run_daily(spark, fresh_bronze, "2001-01-02 12:00:00", root, manifests=manifests)
    n = res.tables["mart_customer_lifetime"].count()
    assert res.quality.count() == 41 and res.published.count() == n == res.n_published
    assert res.tables["customer_history"].where("is_current").count() == res.tables["stg_customers"].count()
    from ferrolake.operators.audit import read_audit
    again = daily.run_daily(spark, fresh_bronze, "2001-01-02 12:00:00", root)   # a rerun replaces its own reports
    assert again.quality.count() == 41 and again.n_published == 0
    assert read_audit(spark, f"{root}/reports/audit_log").count() == 3
    stats = spark.read.parquet(f"{root}/reports/column_statistics")   # a rerun replaces them
    tables = {"dim_customers": 16, "fct_orders": 19, "mart_customer_lifetime": 27}   # the fact's day is its partition
    assert {r.model_name: r["count"] for r in stats.groupBy("model_name").count().collect()} == tables
    assert spark.read.parquet(f"{root}/reports/lineage_models").count() > 0


def test_failed_publish_loses_nothing(spark, monkeypatch):
    import pytest
    from ferrolake.plans import daily
    mart = VersionedTable(spark, scratch_path(spark, "t-pub-mart"))
    root = scratch_path(spark, "t-pub")
    row = lambda v: spark.createDataFrame([("a", v), ("b", 1)], "customer_id string, x int")
    mart.write(row(1))
    real = daily.publish
    for v, n in ((1, 2), (2, 1)):
        if v > 1:
            mart.write(row(v))
        monkeypatch.setattr(daily, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("sink")))
        with pytest.raises(RuntimeError):
            daily.publish_changes(spark, mart, root)
        monkeypatch.setattr(daily, "publish", real)
        assert daily.publish_changes(spark, mart, root)[1] == n
        assert daily.publish_changes(spark, mart, root)[1] == 0


def test_malformed_bronze_values_become_null(spark):
    from ferrolake.sources.bronze import read_raw
    path = scratch_path(spark, "t-raw")
    spark.createDataFrame([("1", "2", "card", "abc", "x", "2001-01-01 00:00:00", "never"), ("x", "2", "card", "1.5", "x", "no", "2001-01-01")],
                          "transaction_id string, order_id string, payment_method string, transaction_amount_eur string, "
                          "transaction_status string, transaction_timestamp string, _ingestion_timestamp string").write.parquet(path)
    rows = {r.transaction_id: r for r in read_raw(spark, "raw_transactions", path).collect()}
    assert rows[1].transaction_amount_eur is None and rows[1]._ingestion_timestamp is None and rows[1].transaction_timestamp is not None
    assert str(rows[None].transaction_amount_eur) == "1.50" and rows[None].transaction_timestamp is None


def test_layout_narrows_string_keys_in_few_files(spark):
    """Files cover narrow ranges of both string columns; small data makes few files whatever the shuffle setting."""
    import glob

    import pyarrow.parquet as pq

    from ferrolake.operators.layout import layout_by
    df = spark.range(20000).select(F.format_string("k%05d", F.pmod(F.xxhash64("id"), F.lit(9000))).alias("k"),
                                   F.concat(F.lit("s"), F.col("id") % 4).alias("s"))
    path = scratch_path(spark, "t-z")
    layout_by(df, ["k", "s"], num_partitions=16).write.parquet(path)
    spans = []
    for f in glob.glob(path.removeprefix("file:") + "/*.parquet"):
        t = pq.read_table(f)
        k = sorted(t["k"].to_pylist())
        spans.append(int(k[-1][1:]) - int(k[0][1:]))
    assert len(spans) >= 12 and sorted(spans)[len(spans) // 2] < 9000 / 2
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        few = scratch_path(spark, "t-few")
        layout_by(df, ["k"]).write.parquet(few)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(glob.glob(few.removeprefix("file:") + "/*.parquet")) <= 4


def test_partition_pruning_on_event_date(spark):
    from conftest import SF_SMALL
    from ferrolake.sources import derived
    from ferrolake.sources.bronze import write_raw_transactions
    path = scratch_path(spark, "t-raw-tx")
    write_raw_transactions(derived.raw_transactions(spark, SF_SMALL), path)
    df = spark.read.parquet(path).where(F.col("event_date") >= F.lit("2001-06-01").cast("date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert df.count() == derived.raw_transactions(spark, SF_SMALL).where(
        F.to_date("transaction_timestamp") >= F.lit("2001-06-01").cast("date")).count()


def test_analyze_table_statistics(spark):
    from ferrolake.operators.layout import analyze_stats, register_table
    path = scratch_path(spark, "t-analyze")
    spark.range(100).withColumn("s", F.col("id").cast("string")).write.parquet(path)
    register_table(spark, "t_analyze", path)
    stats = analyze_stats(spark, "t_analyze").first()
    assert "100 rows" in stats.data_type


def test_versioned_table_vacuum_keeps_newest(spark):
    table = VersionedTable(spark, scratch_path(spark, "t-vacuum"))
    for v in range(4):
        table.upsert(_fact(spark, [("a", "2001-01-01", v)]), "order_id")
    assert table.vacuum(keep=2) == ["v000001", "v000002"]
    assert table.versions() == ["v000003", "v000004"] and _rows(table.read()) == [("a", "2001-01-01", 3)]
