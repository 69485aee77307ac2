"""Kept partials of the look-back features: per customer the days with fulfilled orders, with running totals.

A row holds ``days``: (day, orders, revenue, orders up to and including it, revenue up to and including it), ascending.
A feature "of the last n days" is the difference of two running totals, so the table answers for any as-of date, today's
or an earlier one, without the fact. An array is as long as the customer's days at most, whatever the number of orders: they
are counted per day before anything is collected.

``advance`` follows the fact's manifests. It reads the days rewritten since the last time only, as they were and as they are now, takes these
days out of their customers' rows and puts the new counts in; stored rows are merged bucket by bucket without
being moved (``BucketedTable``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bucketed import BucketedTable
from ..operators.upsert import PartitionedTable, VersionedTable
from .gold import MART_REVENUE_WINDOWS, MART_WINDOWS, MONEY_SUM

_DAY = f"struct<day:date,orders:bigint,revenue:{MONEY_SUM},orders_to:bigint,revenue_to:{MONEY_SUM}>"


def _per_day(fct: DataFrame) -> DataFrame:
    """(customer_id, days): counts of fulfilled orders per day, without running totals."""
    days = (fct.where(F.col("is_fulfilled")).groupBy("customer_id", "order_date")
            .agg(F.count("order_id").alias("orders"), F.coalesce(F.sum("net_revenue_eur"), F.lit(0)).cast(MONEY_SUM).alias("revenue")))
    return days.groupBy("customer_id").agg(F.collect_list(F.struct(F.col("order_date").alias("day"), "orders", "revenue")).alias("days"))


def _with_totals(days: Column) -> Column:
    """Sorted by day, each with the totals up to it."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast(MONEY_SUM).alias("eur"), F.array().cast(f"array<{_DAY}>").alias("out"))

    def add(acc: Column, d: Column) -> Column:
        n, eur = acc["n"] + d["orders"], (acc["eur"] + d["revenue"]).cast(MONEY_SUM)
        entry = F.struct(d["day"].alias("day"), d["orders"].alias("orders"), d["revenue"].alias("revenue"), n.alias("orders_to"), eur.alias("revenue_to"))
        return F.struct(n.alias("n"), eur.alias("eur"), F.concat(acc["out"], F.array(entry)).alias("out"))

    return F.aggregate(F.array_sort(days), zero, add)["out"]


def _bare(days: Column, gone: Sequence[str] = ()) -> Column:
    """Stored days without their totals, and without the days in ``gone``."""
    keep = F.filter(days, lambda d: ~F.array_contains(F.array(*[F.lit(g) for g in gone]).cast("array<date>"), d["day"])) if gone else days
    return F.transform(keep, lambda d: F.struct(d["day"].alias("day"), d["orders"].alias("orders"), d["revenue"].alias("revenue")))


class CustomerDays:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = BucketedTable(spark, f"{root}/gold/customer_days", "customer_id")
        self._mark = VersionedTable(spark, f"{root}/gold/customer_days_mark")

    def _note(self, manifest: str) -> None:
        self._mark.write(self.spark.range(1).select(F.lit(manifest).alias("manifest")).coalesce(1))
        self._mark.vacuum()

    def rebuild(self, fact: PartitionedTable) -> None:
        manifest = fact.versions()[-1]
        self.table.write(_per_day(fact.version(manifest)).select("customer_id", _with_totals(F.col("days")).alias("days")))
        self._note(manifest)

    def advance(self, fact: PartitionedTable) -> list[str]:
        """Bring the totals up to the committed fact; returns the rewritten buckets. The manifest they stand for is noted
        last, so a run that dies in between is caught up by the next one."""
        seen = self._mark.read()
        before = None if seen is None else seen.first()["manifest"]
        if before not in fact.versions():   # never built, or so old that the fact's version is gone
            self.rebuild(fact)
            return sorted(self.table.current())
        manifest, touched = fact.versions()[-1], fact.changed_since(before)
        out = self._replace(fact, before, touched) if touched else []
        self._note(manifest)
        return out

    def _replace(self, fact: PartitionedTable, before: str, touched: Sequence[str]) -> list[str]:
        gone = [t.split("=", 1)[1] for t in touched]
        now = fact.read(list(touched))
        old = fact.version(before, list(touched)).where(F.col("is_fulfilled")).select("customer_id")
        who = old.unionByName(now.where(F.col("is_fulfilled")).select("customer_id")).distinct()
        fresh = who.alias("w").join(_per_day(now).alias("p"), F.col("w.customer_id").eqNullSafe(F.col("p.customer_id")), "left")
        fresh = fresh.select("w.customer_id", F.coalesce("p.days", F.array().cast(f"array<struct<day:date,orders:bigint,revenue:{MONEY_SUM}>>")).alias("days"))
        fresh = fresh.select("customer_id", _with_totals(F.col("days")).alias("days"))

        def joined(name: str, new: Column, stored: Column) -> Column:
            if name != "days":
                return F.coalesce(new, stored)
            whole = _with_totals(F.concat(F.coalesce(_bare(stored, gone), F.array().cast(f"array<struct<day:date,orders:bigint,revenue:{MONEY_SUM}>>")), _bare(new)))
            return F.when(new.isNull(), stored).otherwise(whole)

        return self.table.upsert(fresh, combine=joined)


def features_as_of(customer_days: DataFrame, as_of) -> DataFrame:
    """Look-back counts and sums per customer with fulfilled orders up to the as-of date (windows inclusive, on dates)."""
    today = F.to_date(F.lit(as_of).cast("timestamp"))

    def upto(day: Column, field: str) -> Column:
        before = F.filter("days", lambda d: d["day"] <= day)
        return F.when(F.size(before) > 0, F.element_at(before, -1)[field]).otherwise(F.lit(0))

    def last(n: int, field: str) -> Column:
        return upto(today, field) - upto(F.date_sub(today, n + 1), field)

    return customer_days.where(F.exists("days", lambda d: d["day"] <= today)).select(
        "customer_id", *[last(n, "orders_to").cast("bigint").alias(f"orders_last_{n}d") for n in MART_WINDOWS],
        *[last(n, "revenue_to").cast(MONEY_SUM).alias(f"revenue_last_{n}d") for n in MART_REVENUE_WINDOWS])
