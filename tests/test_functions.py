import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ferrolake.functions.columns import days_between, rolling_sum, safe_divide


def test_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "n double, d double")
    assert [r.q for r in df.select(safe_divide("n", "d").alias("q")).collect()] == [None, None, 1.5]


def test_days_between(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 1, 1, 23), dt.datetime(2001, 1, 3, 1))], "a timestamp, b timestamp")
    assert df.select(days_between("a", "b").alias("d")).first().d == 2


def test_rolling_sum_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = [(f"c{rnd.randint(0, 3)}", dt.date(2001, 1, 1) + dt.timedelta(days=rnd.randint(0, 90)),
             Decimal(rnd.randint(1, 1000)) / 100) for _ in range(300)]
    df = spark.createDataFrame(rows, "customer_id string, d date, m decimal(18,2)").withColumn("i", F.monotonically_increasing_id())
    got = {r.i: r.s for r in rolling_sum(df, "m", "d", 30, alias="s").collect()}
    ids = {r.i: (r.customer_id, r.d) for r in df.collect()}
    for i, (c, d) in ids.items():
        want = sum(m for cc, dd, m in rows if cc == c and d - dt.timedelta(days=30) <= dd <= d)
        assert got[i] == want
