"""Write-time layout: partitioned writes, clustering on one or two columns, table statistics.

Clustering replaces ``OPTIMIZE ... ZORDER BY``: rows are range-partitioned and sorted on the
column (one column) or on an interleaved z-value of two bucketed columns, so each output file
covers a narrow key range and min/max statistics let Parquet skip files.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .files import delete

SAMPLE_VALUES = 4096   # distinct values from which a string column's cut points are taken


def _z_bits(df: DataFrame) -> int:
    """Buckets per column follow the number of files a large write makes: about four cells for each."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4, math.ceil(math.log2(max(2, n)) / 2) + 1)


def _cuts(df: DataFrame, col: str, n: int) -> tuple[Column, list]:
    """The column in comparable form and at most n - 1 cut points: only those reach the driver.

    Numbers and dates: approximate quantiles of the rows. Strings: quantiles of a bounded sample of their
    distinct values (those with the smallest hashes; a top-k, so combined before it is shuffled).
    """
    dt = df.schema[col].dataType
    if isinstance(dt, T.StringType):
        some = (df.select(F.col(col).alias("v")).where(F.col("v").isNotNull()).distinct()
                .orderBy(F.xxhash64("v"), "v").limit(SAMPLE_VALUES).collect())
        values = sorted((r.v for r in some), key=lambda v: v.encode())
        return F.col(col), sorted({values[len(values) * i // n] for i in range(1, n)}, key=lambda v: v.encode()) if values else []
    num = F.col(col).cast("double") if isinstance(dt, T.NumericType) else F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    return num, sorted(set(df.select(num.alias("v")).approxQuantile("v", [i / n for i in range(1, n)], 0.01)))


def _bucket(df: DataFrame, col: str, bits: int) -> Column:
    """Order-preserving bucket number: how many cut points are not above the value (found by halving)."""
    value, cuts = _cuts(df, col, 1 << bits)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value >= F.lit(cuts[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))

    return F.when(value.isNull(), F.lit(0)).otherwise(search(0, len(cuts)))


def z_value(a: Column, b: Column, bits: int) -> Column:
    """Interleave the bits of two bucket numbers: a on even, b on odd positions."""
    z = F.lit(0).cast("long")
    for i in range(bits):
        z = z.bitwiseOR(F.shiftleft(F.shiftright(a.cast("long"), i).bitwiseAND(1), 2 * i))
        z = z.bitwiseOR(F.shiftleft(F.shiftright(b.cast("long"), i).bitwiseAND(1), 2 * i + 1))
    return z


def _ranged(df: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """Range partitions. Without ``n`` adaptive execution merges small ones, so files follow the bytes written."""
    return df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)


def _row_hash(df: DataFrame) -> Column:
    """Deterministic per-row tiebreak: lets a range split rows that share the clustering key (a hot
    customer, a hot day) over several tasks. Deterministic, so a retried task routes rows the same."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def layout_by(df: DataFrame, cols: Sequence[str], num_partitions: int | None = None,
              within: Sequence[str] = ()) -> DataFrame:
    """Cluster rows on one or two columns before a write (``within`` = leading partition columns). ``df`` is read for
    each cut point and again for the ranges: give it stored rows, or use ``clustered_write``."""
    cols = list(cols)
    n = num_partitions
    if len(cols) == 1:
        keys = [*within, cols[0]]
        return _ranged(df.withColumn("__h", _row_hash(df)), n, *keys, "__h").sortWithinPartitions(*keys).drop("__h")
    if len(cols) != 2:
        raise ValueError("layout_by clusters on one or two columns")
    bits = _z_bits(df)
    zed = df.withColumn("__z", z_value(_bucket(df, cols[0], bits), _bucket(df, cols[1], bits), bits)).withColumn("__h", _row_hash(df))
    keys = [*within, "__z"]
    return _ranged(zed, n, *keys, "__h").sortWithinPartitions(*keys, *cols).drop("__z", "__h")


def spread_by(df: DataFrame, partition_col: str, num_partitions: int | None = None) -> DataFrame:
    """Group rows by a partition column for a ``partitionBy`` write without letting one hot value
    land in one task: range on (value, row hash) keeps each task on few directories and splits a
    large directory over several tasks/files."""
    return _ranged(df.withColumn("__h", _row_hash(df)), num_partitions, partition_col, "__h").drop("__h")


def clustered_write(df: DataFrame, path: str, cols: Sequence[str] = (), partition_col: str | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` clustered on ``cols`` (inside the folders of ``partition_col``).

    Cut points, the sample for the ranges and the write itself all read their input. ``df`` may be a long plan, so
    it is worked out and stored once, and the stored rows are then laid out.
    """
    spark = df.sparkSession
    stage = scratch_path(spark, "layout-stage")
    df.write.parquet(stage)
    rows = spark.read.schema(df.schema).parquet(stage)
    within = [partition_col] if partition_col else []
    out = layout_by(rows, cols, within=within) if cols else spread_by(rows, partition_col)
    writer = out.write.mode(mode)
    (writer.partitionBy(partition_col) if partition_col else writer).parquet(path)
    delete(spark, stage)


def partitioned_write(df: DataFrame, path: str, partition_col: str, mode: str = "overwrite",
                      cluster: Sequence[str] = ()) -> None:
    """``partitionBy`` write; rows are first range-grouped by the partition column so each task
    writes few partition directories (no tiny-file explosion), optionally clustered inside them."""
    clustered_write(df, path, cluster, partition_col, mode)


def register_table(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}") if _is_partitioned(spark, name) else None


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    return bool(spark.catalog.listColumns(name) and any(c.isPartition for c in spark.catalog.listColumns(name)))


def analyze_stats(spark: SparkSession, name: str) -> DataFrame:
    """``ANALYZE TABLE ... COMPUTE STATISTICS FOR ALL COLUMNS``; returns the table-level statistics."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Statistics")


def analyzed_columns(spark: SparkSession, name: str) -> DataFrame:
    """What ``ANALYZE`` stored in the catalog, one row per column: rows, NULLs, longest string."""
    text = analyze_stats(spark, name).first()["data_type"]
    rows = int(re.search(r"(\d+) rows", text)[1])
    out = []
    for f in spark.table(name).schema.fields:
        info = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} `{f.name}`").collect()}
        longest = int(info["max_col_len"]) if isinstance(f.dataType, T.StringType) and info["max_col_len"] != "NULL" else None
        out.append((f.name, rows, int(info["num_nulls"]), longest))
    return spark.createDataFrame(out, "column_name string, row_count long, null_count long, max_length long")


def column_stats(df: DataFrame) -> DataFrame:
    """Exact per-column row count, NULL count and (strings) maximum length in ONE pass, as rows.

    Every measure is an algebraic aggregate, merged map-side; the wide row is turned into one row
    per column with ``stack``.
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for f in df.schema.fields:
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"n__{f.name}"))
        if isinstance(f.dataType, T.StringType):
            aggs.append(F.max(F.length(f.name)).cast("bigint").alias(f"l__{f.name}"))
        else:
            aggs.append(F.lit(None).cast("bigint").alias(f"l__{f.name}"))
    wide = df.agg(*aggs)
    pieces = ", ".join(f"'{f.name}', `n__{f.name}`, `l__{f.name}`" for f in df.schema.fields)
    return wide.select(F.col("__rows").alias("row_count"),
                       F.expr(f"stack({len(df.schema.fields)}, {pieces}) as (column_name, null_count, max_length)")) \
        .select("column_name", "row_count", "null_count", "max_length")
