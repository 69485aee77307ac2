"""Data-quality assertions: each test is a predicate over a model giving
``(model, column_name, test, failing_rows, passed)``.

NULL passes every test but ``not_null``; ``unique`` ignores NULL and counts duplicated values;
``relationships`` counts child rows (non-NULL key) without a parent.

All tests of all models share one pass and one shuffle by *tagged counting*. A row becomes events (check, key): one
for each uniqueness test and relationship it takes part in, with the value as key, and one without a key for each
row-level test it fails. Events are counted per (check, key), first in the map tasks, so a hot key and the failures
of a check travel as one row per task; a second count per check gives the report. A value is duplicated if its
count is above 1, an orphan if it was seen as a child and never as a parent. Keys are compared as values, not hashes.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_LEVEL = ("not_null", "accepted_values", "between", "matches_regex", "length_between")

REPORT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("column_name", T.StringType()),
    T.StructField("test", T.StringType()), T.StructField("failing_rows", T.LongType()),
    T.StructField("passed", T.BooleanType()),
])


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    args: dict = field(default_factory=dict, hash=False, compare=False)


def _num(x) -> Column:
    """Exact decimal literal for a bound, so 0.01 is compared as 0.01, not as a double."""
    return F.lit(Decimal(str(x)))


def failure(check: Check) -> Column:
    """Row-level failure predicate (NULL-safe: NULL never fails except for ``not_null``)."""
    c = F.col(check.column)
    a = check.args
    if check.test == "not_null":
        return c.isNull()
    if check.test == "accepted_values":
        cond = ~c.isin(list(a["values"]))
    elif check.test == "between":
        cond = (c < _num(a["min"])) | (c > _num(a["max"]))
    elif check.test == "matches_regex":
        cond = ~c.rlike(a["regex"])
    elif check.test == "length_between":
        cond = (F.length(c) < a["min"]) | (F.length(c) > a["max"])
    else:
        raise ValueError(check.test)
    return c.isNotNull() & cond


def wrong_type(df: DataFrame, check: Check) -> int:
    """Schema-level: 0 failures when the column has the expected type, else 1."""
    return 0 if df.schema[check.column].dataType.simpleString() == check.args["type"] else 1


def _event(check: int, key: Column, child: int, parent: int, when: Column) -> Column:
    return F.when(when, F.struct(F.lit(check).alias("check"), key.cast("string").alias("key"),
                                 F.lit(child).cast("long").alias("child"), F.lit(parent).cast("long").alias("parent")))


def run_checks(models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Evaluate checks over the named models; one row per check. Every model is read once."""
    spark = next(iter(models.values())).sparkSession
    if not checks:
        return spark.createDataFrame([], REPORT_SCHEMA)
    events: dict[str, list[Column]] = {}
    for i, ck in enumerate(checks):
        value = F.col(ck.column)
        if ck.test in ROW_LEVEL:
            events.setdefault(ck.model, []).append(_event(i, F.lit(""), 1, 0, failure(ck)))
        elif ck.test in ("unique", "relationships"):
            events.setdefault(ck.model, []).append(_event(i, value, 1, 0, value.isNotNull()))
        if ck.test == "relationships":
            key = F.col(ck.args["field"])
            events.setdefault(ck.args["to"], []).append(_event(i, key, 0, 1, key.isNotNull()))
    parts = [models[m].select(F.inline(F.array_compact(F.array(*cols)))) for m, cols in events.items()]
    rows = [(i, ck.model, ck.column, ck.test, wrong_type(models[ck.model], ck) if ck.test == "of_type" else 0) for i, ck in enumerate(checks)]
    report = spark.createDataFrame(rows, "check int, model string, column_name string, test string, schema_failures long")
    if parts:
        keys = reduce(DataFrame.unionAll, parts).groupBy("check", "key").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))

        def of(kind: str) -> Column:
            return F.col("check").isin([i for i, ck in enumerate(checks) if ck.test == kind])
        failing = (F.when(of("unique"), F.when(F.col("child") > 1, 1).otherwise(0))
                   .when(of("relationships"), F.when(F.col("parent") == 0, F.col("child")).otherwise(0)).otherwise(F.col("child")))
        report = report.join(keys.groupBy("check").agg(F.sum(failing).alias("found")), "check", "left")
    else:
        report = report.withColumn("found", F.lit(0))
    n = (F.coalesce("found", F.lit(0)) + F.col("schema_failures")).cast("bigint")
    return report.select("model", "column_name", "test", n.alias("failing_rows"), (n == 0).alias("passed"))
