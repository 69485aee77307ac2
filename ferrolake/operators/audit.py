"""Run audit: an append-only row-count log per model run, and a two-version table comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def audit_row(df: DataFrame, model_name: str, environment: str, run_at) -> DataFrame:
    """``(model_name, environment, run_at, row_count)`` for one model run (a global count)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(model_name).alias("model_name"), F.lit(environment).alias("environment"),
        F.lit(run_at).cast("timestamp").alias("run_at"), "row_count")


def write_run(df: DataFrame, path: str, keys: list[str]) -> None:
    """Write a report's rows under their run's keys, replacing those of an earlier attempt at the same run."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))


def audit_append(df: DataFrame, path: str, model_name: str, environment: str, run_at) -> None:
    """Add the audit row to the log (a Parquet directory shared by all runs); a rerun replaces its own row."""
    row = audit_row(df, model_name, environment, run_at).coalesce(1)
    write_run(row, path, ["run_at", "environment", "model_name"])


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("model_name string, environment string, run_at timestamp, row_count long").parquet(path)


def audit_compare(before: DataFrame, after: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """Rows added / removed / changed between two versions of a keyed table, and per column how
    many matched rows changed value (NULL-safe). Columns starting with ``_`` (audit) are skipped by
    default. One full outer join on the key, then one aggregate of conditional counts.
    """
    cols = columns or [c for c in after.columns if c != key and not c.startswith("_") and c in before.columns]
    b = before.select(F.col(key).alias("__k"), *[F.col(c).alias(f"b__{c}") for c in cols]).withColumn("__in_b", F.lit(True))
    a = after.select(F.col(key).alias("__k"), *[F.col(c).alias(f"a__{c}") for c in cols]).withColumn("__in_a", F.lit(True))
    j = b.join(a, "__k", "full_outer")
    matched = F.col("__in_a").isNotNull() & F.col("__in_b").isNotNull()
    diffs = [~F.col(f"b__{c}").eqNullSafe(F.col(f"a__{c}")) for c in cols]
    any_diff = diffs[0]
    for d in diffs[1:]:
        any_diff = any_diff | d
    aggs = [F.count_if(F.col("__in_b").isNull()).alias("rows_added"),
            F.count_if(F.col("__in_a").isNull()).alias("rows_removed"),
            F.count_if(matched & any_diff).alias("rows_changed")]
    aggs += [F.count_if(matched & d).alias(f"c{i}") for i, d in enumerate(diffs)]
    stacked = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return j.agg(*aggs).select("rows_added", "rows_removed", "rows_changed",
                               F.expr(f"stack({len(cols)}, {stacked}) as (column_name, values_changed)"))
