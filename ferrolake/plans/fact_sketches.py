"""Column statistics of the fact from sketches that merge: no rescan of days that did not change.

For every ``order_date`` partition and column a row holds its rows, NULLs, longest string, a HyperLogLog sketch of the
values (distinct count) and, for numbers, a KLL sketch (quantiles). ``advance`` follows the fact's manifests and works
out the rows of changed partitions only; ``statistics`` merges the sketches of all partitions, which are as many as days
times columns, whatever the number of orders.

Error bounds: distinct counts have a relative standard error of about 1.04 / sqrt(2^12) = 1.6 %; the rank of a quantile is
off by at most about 1.7 % (KLL with k = 200, 99 % confidence). Rows, NULLs and lengths are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import PartitionedTable, VersionedTable

QUANTILES = (0.25, 0.5, 0.75)
_ROW = "struct<column_name:string,row_count:bigint,null_count:bigint,max_length:bigint,values:binary,ranks:binary>"


def _sketches(df: DataFrame, day: str) -> DataFrame:
    """One row per day and column (but the day itself); partial sketches are merged in the shuffle."""
    rows, aggs = [], [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(x for x in df.schema.fields if x.name != day):
        c = F.col(f"`{f.name}`")
        text, number = isinstance(f.dataType, T.StringType), isinstance(f.dataType, T.NumericType)
        aggs += [F.count_if(c.isNull()).alias(f"z{i}"), F.hll_sketch_agg(c.cast("string")).alias(f"v{i}"),
                 (F.max(F.length(c)).cast("bigint") if text else F.lit(None).cast("bigint")).alias(f"l{i}"),
                 (F.kll_sketch_agg_double(c.cast("double")) if number else F.lit(None).cast("binary")).alias(f"k{i}")]
        rows.append(F.struct(F.lit(f.name).alias("column_name"), F.col("n").alias("row_count"), F.col(f"z{i}").alias("null_count"),
                             F.col(f"l{i}").alias("max_length"), F.col(f"v{i}").alias("values"), F.col(f"k{i}").alias("ranks")).cast(_ROW))
    return df.groupBy(F.col(day).cast("string").alias("day")).agg(*aggs).select("day", F.inline(F.array(*rows)))


class FactSketches:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = VersionedTable(spark, f"{root}/gold/fct_orders_sketches")

    def advance(self, fact: PartitionedTable) -> list[str]:
        """Bring the sketches up to the committed fact; returns the partitions that were read. Sketches and the manifest
        they stand for are one version of one table, so an interrupted run changes nothing."""
        seen, now = self.table.read(), fact.versions()[-1]
        before = None if seen is None else seen.agg(F.max("manifest")).first()[0]
        if before == now:
            return []
        fresh = before not in fact.versions()
        touched = sorted(fact.current()) if fresh else fact.changed_since(before)
        new = _sketches(fact.read(touched), fact.partition_col)
        if not fresh:
            days = [t.split("=", 1)[1] for t in touched]
            new = new.unionByName(seen.drop("manifest").where(~F.coalesce("day", F.lit("__HIVE_DEFAULT_PARTITION__")).isin(days)))
        self.table.write(new.withColumn("manifest", F.lit(now)))
        self.table.vacuum()
        return touched

    def statistics(self) -> DataFrame:
        """Per column: rows, NULLs, longest string, distinct values (about), quartiles (about, numbers only)."""
        def rank(q: float) -> Column:
            some = F.kll_sketch_get_n_double("ranks") > 0   # merging nothing gives an empty sketch
            return F.when(some, F.kll_sketch_get_quantile_double("ranks", F.lit(q))).alias(f"q{int(q * 100)}")

        merged = self.table.read().groupBy("column_name").agg(
            F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.max("max_length").alias("max_length"),
            F.hll_sketch_estimate(F.hll_union_agg("values")).alias("distinct_about"), F.kll_merge_agg_double("ranks").alias("ranks"))
        return merged.select("column_name", "row_count", "null_count", "max_length", "distinct_about", *[rank(q) for q in QUANTILES])
