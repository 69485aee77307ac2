"""Sketches per partition: merged statistics, error bounds, and which partitions are read."""

import datetime as dt

from pyspark.sql import functions as F

from ferrolake.operators.upsert import PartitionedTable
from ferrolake.plans.fact_sketches import FactSketches
from ferrolake.session import scratch_path


def _fact(spark, lo, hi, day="2001-01-01"):
    return spark.range(lo, hi).select(F.col("id").cast("string").alias("order_id"), F.expr(f"date'{day}' + cast(id % 5 as int)").alias("order_date"),
                                      (F.col("id") % 1000).cast("decimal(18,2)").alias("eur"),
                                      F.when(F.col("id") % 4 > 0, F.concat(F.lit("m"), (F.col("id") % 3).cast("string"))).alias("method"))


def test_statistics_merge_over_partitions(spark):
    root = scratch_path(spark, "s-root")
    fact, sketches = PartitionedTable(spark, f"{root}/fct", "order_date"), FactSketches(spark, root)
    fact.write(_fact(spark, 0, 20000))
    assert len(sketches.advance(fact)) == 5 and sketches.advance(fact) == []
    late = spark.createDataFrame([("x1", dt.date(2001, 1, 3), None, "a long method"), ("7", dt.date(2001, 2, 1), None, None)],
                                 "order_id string, order_date date, eur decimal(18,2), method string")
    fact.upsert(late, "order_id")   # order 7 leaves its day
    assert sorted(sketches.advance(fact)) == ["order_date=2001-01-03", "order_date=2001-02-01"]
    got = {r.column_name: r for r in sketches.statistics().collect()}
    rows = fact.read()
    for c in ("order_id", "eur", "method"):
        exact = rows.agg(F.count("*").alias("n"), F.count_if(F.col(c).isNull()).alias("z"), F.count_distinct(c).alias("d"),
                         F.max(F.length(F.col(c).cast("string"))).alias("l")).first()
        assert (got[c].row_count, got[c].null_count) == (exact.n, exact.z)
        assert abs(got[c].distinct_about - exact.d) <= max(1, 4 * 0.0163 * exact.d)   # four standard errors
    assert got["method"].max_length == 13 and got["order_id"].q50 is None
    for q in (25, 50, 75):   # the rank of a quantile is off by less than 2 %
        below = rows.where(F.col("eur") <= got["eur"][f"q{q}"]).count() / rows.where("eur is not null").count()
        assert abs(below - q / 100) < 0.02
