"""The daily run as one plain function: freshness -> Silver -> dimension -> customer history -> fact
-> mart -> quality -> audit with column statistics -> feature publish -> lineage. A freshness ``error``
stops the run before any model is built. Outputs go below ``root`` (a folder on shared storage).

Reruns after a failure are safe: tables change only when their marker is committed, reports are
written per run and a rerun replaces its own rows, and features are compared with the version that was
published last, so a failed sink loses nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import audit_append, write_run
from ..operators.history import snapshot_scd2
from ..operators.layout import column_stats
from ..operators.publish import changed_rows, publish, to_records
from ..operators.upsert import PartitionedTable, VersionedTable
from ..sources.manifests import read_manifests
from . import pipeline, silver
from .fact_sketches import FactSketches
from .lineage import lineage_columns, lineage_edges, lineage_models, public
from .reports import dq_report, freshness_report
from .winners import Winners

VERSIONED = ("gold/dim_customers", "gold/customer_history")


class StaleSourceError(RuntimeError):
    pass


@dataclass
class DailyResult:
    freshness: DataFrame
    tables: dict[str, DataFrame]
    quality: DataFrame
    published: DataFrame
    n_published: int


def publish_changes(spark: SparkSession, mart_table: VersionedTable | PartitionedTable, root: str, sink: str = "parquet",
                    options: dict | None = None) -> tuple[DataFrame, int]:
    """Send the customers whose features differ from the version published last; then note the version.

    The marker is written after the sink has succeeded: a failed run is repeated in full (at least once,
    keyed records), and no change is lost.
    """
    marker = VersionedTable(spark, f"{root}/published/marker")
    seen = marker.read()
    last = seen.first()["version"] if seen is not None else None
    current = mart_table.versions()[-1]
    changes = changed_rows(mart_table.version(last), mart_table.read(), "customer_id")
    records = to_records(changes, "customer_id")
    n = publish(records, sink=sink, path=f"{root}/published/customer_features/{current}", options=options)
    marker.write(spark.createDataFrame([(current,)], "version string"))
    marker.vacuum()
    mart_table.vacuum(pinned=current)
    return records, n


def write_statistics(spark: SparkSession, tables: dict[str, DataFrame], root: str, environment: str, run_at) -> None:
    """Column statistics of the Gold tables beside the audit log. The fact's are merged from the sketches of its partitions,
    of which only changed ones are read; dimension and mart are counted in one pass each."""
    sketches = FactSketches(spark, root)
    sketches.advance(pipeline.fact_table(spark, root))
    found = {"fct_orders": sketches.statistics()} | {n: column_stats(tables[n]) for n in ("dim_customers", "mart_customer_lifetime")}
    for name, stats in found.items():
        row = stats.withColumns({"run_at": run_at, "environment": F.lit(environment), "model_name": F.lit(name)}).coalesce(1)
        write_run(row, f"{root}/reports/column_statistics", ["run_at", "environment", "model_name"])


def write_lineage(spark: SparkSession, manifests: str, root: str, run_at) -> None:
    """The lineage tables of the run's manifests, the last step of a run."""
    models = lineage_models(read_manifests(spark, manifests))
    for name, df in {"models": public(models), "columns": lineage_columns(models), "edges": lineage_edges(models)}.items():
        write_run(df.withColumn("run_at", run_at), f"{root}/reports/lineage_{name}", ["run_at"])


def run_daily(spark: SparkSession, bronze: dict[str, DataFrame], as_of, root: str, environment: str = "prod",
              publish_sink: str = "parquet", publish_options: dict | None = None, manifests: str | None = None) -> DailyResult:
    """``manifests``: the folder of the run's manifests, if lineage is to be written."""
    run_at = F.lit(as_of).cast("timestamp")
    fresh = freshness_report(bronze, as_of)
    write_run(fresh.withColumn("run_at", run_at), f"{root}/reports/freshness", ["run_at"])
    stale = [r.source for r in fresh.where("status = 'error'").select("source").collect()]
    if stale:   # at most one row per source
        raise StaleSourceError(f"sources past the error threshold: {stale}")

    mart_table = pipeline.mart_table(spark, root)
    tables = dict(pipeline.run_incremental(spark, bronze, as_of, root).tables)
    history = VersionedTable(spark, f"{root}/gold/customer_history")
    history.write(snapshot_scd2(history.read(), tables["stg_customers"], "customer_id"))
    tables["customer_history"] = history.read()

    write_run(dq_report(tables).withColumn("run_at", run_at), f"{root}/reports/dq_report", ["run_at"])
    for name in ("dim_customers", "fct_orders", "mart_customer_lifetime"):
        audit_append(tables[name], f"{root}/reports/audit_log", name, environment, as_of)
    write_statistics(spark, tables, root, environment, run_at)
    records, n = publish_changes(spark, mart_table, root, publish_sink, publish_options)
    if manifests:
        write_lineage(spark, manifests, root, run_at)
    # Retention: the current and the previous version of each table stay.
    for name in VERSIONED:
        VersionedTable(spark, f"{root}/{name}").vacuum(keep=2)
    pipeline.fact_table(spark, root).vacuum(keep=2)
    for feed in silver.RANKS:
        Winners(spark, root, feed).table.vacuum(keep=2)
    quality = spark.read.parquet(f"{root}/reports/dq_report").where(F.col("run_at") == run_at)
    return DailyResult(fresh, tables, quality, records, n)
