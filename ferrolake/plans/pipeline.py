"""Model graph wiring: Bronze -> Silver -> dimension -> fact -> mart, at a point in time.

``models(...)`` returns lazy DataFrames (one plan, nothing stored). ``run_full`` and
``run_incremental`` are the daily jobs: each layer is written once to Parquet and read back, so
deduplication (read by two Gold models) is done once, every later stage starts from stored files
(lineage is cut, a lost executor only recomputes from the last stored layer), and the previous
run's tables are real tables the incremental run merges into. Silver stays a view: a projection and
filter over the kept winners of each feed.

Storage under ``root``: ``winners/<feed>`` (hash buckets of the key, a batch is merged into), ``gold/dim_customers/v*``
(versioned full writes), ``gold/fct_orders`` (partitioned by ``order_date``, upserted partition by partition) and
``gold/mart_customer_lifetime`` and ``gold/customer_days`` (hash buckets, upserted bucket by bucket); changes are committed
by a manifest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bucketed import BucketedTable
from ..operators.upsert import PartitionedTable, VersionedTable
from ..session import scratch_path
from ..sources import derived
from . import gold, silver
from .customer_days import CustomerDays
from .winners import Winners, advance

# The evaluation clock of the test fixtures, and the earlier run used by incremental scenarios.
AS_OF = "2001-07-01 00:00:00"
PREV = "2001-06-01 00:00:00"

FACT_CLUSTER = ["customer_id", "order_status"]
MART_CLUSTER = ["customer_segment", "customer_status"]


def models(bronze: dict[str, DataFrame], as_of) -> dict[str, DataFrame]:
    out = dict(bronze)
    out.update(silver.silver(bronze, as_of))
    out["dim_customers"] = gold.dim_customers(out["stg_customers"], out["stg_orders"], as_of)
    out["fct_orders"] = gold.fct_orders(out["stg_orders"], out["stg_transactions"], out["dim_customers"], as_of)
    out["mart_customer_lifetime"] = gold.mart_customer_lifetime(out["dim_customers"], out["fct_orders"], as_of)
    return out


def models_from_tables(spark: SparkSession, sf_dir: str, as_of=AS_OF, cutoff=None) -> dict[str, DataFrame]:
    """All models over the Bronze feeds derived from the driver's tables (Bronze as of ``cutoff``)."""
    return models(derived.bronze(spark, sf_dir, cutoff), as_of)


def _store(spark: SparkSession, df: DataFrame, path: str, cluster=()) -> DataFrame:
    table = VersionedTable(spark, path)
    table.write(df, cluster=cluster)
    return table.read()


def _staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _silver_and_dim(spark: SparkSession, winners: dict[str, DataFrame], as_of, root: str) -> dict[str, DataFrame]:
    out = silver.views(winners, as_of)
    dim = gold.dim_customers(out["stg_customers"], out["stg_orders"], as_of)
    out["dim_customers"] = _store(spark, dim, f"{root}/gold/dim_customers", cluster=["customer_id"])
    return out


def mart_table(spark: SparkSession, root: str) -> BucketedTable:
    return BucketedTable(spark, f"{root}/gold/mart_customer_lifetime", "customer_id", within=MART_CLUSTER)


def fact_table(spark: SparkSession, root: str) -> PartitionedTable:
    return PartitionedTable(spark, f"{root}/gold/fct_orders", "order_date", cluster=FACT_CLUSTER)


def fact_lookback_bound(fact: PartitionedTable, days: int = gold.LOOKBACK_DAYS):
    """``max(order_timestamp) - days`` of the committed fact without scanning it.

    ``order_date`` is ``date(order_timestamp)``, so the maximum lies in the newest committed
    ``order_date`` partition: its name is in the manifest, and only that folder is read. None for an
    empty fact.
    """
    days_there = fact.partitions()
    if not days_there:
        return None
    return gold.lookback_bound(fact.read([f"order_date={days_there[-1]}"]), "order_timestamp", days)


def run_full(spark: SparkSession, bronze: dict[str, DataFrame], as_of, root: str) -> dict[str, DataFrame]:
    """Full rebuild of every layer (also the cure for everything the look-back misses)."""
    winners = {feed: Winners(spark, root, feed) for feed in silver.RANKS}
    for feed, kept in winners.items():
        kept.rebuild(bronze[feed])
    out = _silver_and_dim(spark, {feed: kept.read() for feed, kept in winners.items()}, as_of, root)
    fact = fact_table(spark, root)
    fact.write(gold.fct_orders(out["stg_orders"], out["stg_transactions"], out["dim_customers"], as_of))
    out["fct_orders"] = fact.read()
    CustomerDays(spark, root).rebuild(fact)
    mart = mart_table(spark, root)
    mart.write(gold.mart_customer_lifetime(out["dim_customers"], out["fct_orders"], as_of))
    out["mart_customer_lifetime"] = mart.read()
    return out


@dataclass
class IncrementalRun:
    tables: dict[str, DataFrame]   # Silver, dimension, fact and mart after the run
    fct_batch: DataFrame           # look-back batch of the fact
    mart_batch: DataFrame          # customers with recent fulfilled orders


def run_incremental(spark: SparkSession, bronze: dict[str, DataFrame], as_of, root: str,
                    new: dict[str, DataFrame] | None = None) -> IncrementalRun:
    """Incremental run into the tables of an earlier run under ``root`` (full mode if none).

    ``new``: the Bronze rows that arrived since then, for callers that know them (a stream, a list of files); else
    they are found by their ingestion time.
    """
    fact, mart = fact_table(spark, root), mart_table(spark, root)
    if not fact.exists() or not mart.exists():
        out = run_full(spark, bronze, as_of, root)
        return IncrementalRun(out, out["fct_orders"], out["mart_customer_lifetime"])
    out = _silver_and_dim(spark, advance(spark, root, bronze, new), as_of, root)
    bound = fact_lookback_bound(fact)
    fct_batch = gold.fct_orders(out["stg_orders"], out["stg_transactions"], out["dim_customers"], as_of, target=fact.read(),
                                bound=bound)
    # Both batches are stored once: they are merged, and the caller may look at them.
    fct_batch = _staged(spark, fct_batch, "fct-batch")
    fact.upsert(fct_batch, "order_id")
    out["fct_orders"] = fact.read()
    CustomerDays(spark, root).advance(fact)
    mart_batch = gold.mart_customer_lifetime(out["dim_customers"], out["fct_orders"], as_of, target=mart.read())
    mart_batch = _staged(spark, mart_batch, "mart-batch")
    mart.upsert(mart_batch.where(F.col("customer_id").isNotNull()))
    out["mart_customer_lifetime"] = mart.read()
    return IncrementalRun(out, fct_batch, mart_batch)


def incremental_from_tables(spark: SparkSession, sf_dir: str, prev=PREV, as_of=AS_OF) -> IncrementalRun:
    """Full run at ``prev`` on Bronze as ingested by then, then an incremental run at ``as_of``."""
    root = scratch_path(spark, "lakehouse")
    run_full(spark, derived.bronze(spark, sf_dir, prev), prev, root)
    return run_incremental(spark, derived.bronze(spark, sf_dir), as_of, root)
