"""Kept winners: the newest version of every key of a Bronze feed, stored in hash buckets of the key.

Deduplicating a feed is a maximum per key, so it need not start again with every run: a batch is deduplicated by
itself and merged into the kept winners (``BucketedTable.upsert``: only the batch is shuffled, only touched buckets are
read and written). The result equals deduplicating all of Bronze, whatever the order in which rows arrive, as a
late older version loses against the stored one; applying a batch again changes nothing.

``new_rows`` takes from a feed what was ingested since the newest row applied so far, and again the last
``OVERLAP`` before it, as writers that run side by side may commit out of order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bucketed import KEY, BucketedTable, _key, newer
from ..operators.upsert import VersionedTable
from . import silver

OVERLAP = "INTERVAL 1 DAY"


class Winners:
    def __init__(self, spark: SparkSession, root: str, feed: str):
        self.spark, self.feed = spark, feed
        self.key, self.rank = silver.RANKS[feed]
        self.table = BucketedTable(spark, f"{root}/winners/{feed}", self.key)
        self._mark = VersionedTable(spark, f"{root}/winners_mark/{feed}")

    def exists(self) -> bool:
        return self.table.exists()

    def read(self) -> DataFrame:
        return self.table.read()

    def _note(self, raw: DataFrame) -> None:
        """The newest ingestion time applied: noted after the rows are committed, so a run that dies repeats them."""
        top = raw.agg(F.max(F.unix_micros(F.col("_ingestion_timestamp").try_cast("timestamp"))).alias("m")).first()["m"]
        before = self.mark()
        if top is not None and (before is None or top > before):
            self._mark.write(self.spark.range(1).select(F.lit(top).cast("long").alias("m")).coalesce(1))
            self._mark.vacuum()

    def mark(self) -> int | None:
        seen = self._mark.read()
        return None if seen is None else seen.first()["m"]

    def rebuild(self, raw: DataFrame) -> None:
        """Deduplicate the whole feed. Where the session has as many shuffle partitions as the table buckets, versions meet by
        the hashed key that deals rows into buckets, so the window's exchange is the only one (with the top-1 limit before it)."""
        if self.table.buckets == int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            columns = silver.keyed(self.feed, raw).columns
            best = silver.dedup(self.feed, raw, lambda rows: (rows.withColumn(KEY, _key(self.key)).drop(self.key), KEY))
            # The hashed key is '-' for NULL, else '=' and the key, which therefore need not be moved beside it.
            best = best.withColumn(self.key, F.when(F.col(KEY) != "-", F.expr(f"substring({KEY}, 2)"))).select(*columns)
            self.table.write(self.table._placed(best))
        else:
            self.table.write(silver.dedup(self.feed, raw))
        self._note(raw)

    def new_rows(self, raw: DataFrame) -> DataFrame:
        mark = self.mark()
        if mark is None:
            return raw
        at = F.col("_ingestion_timestamp").try_cast("timestamp")
        return raw.where(at.isNull() | (at > F.timestamp_micros(F.lit(mark)) - F.expr(OVERLAP)))

    def apply(self, batch: DataFrame) -> list[str]:
        """Merge a batch of raw rows; returns the rewritten buckets."""
        best = silver.dedup(self.feed, batch)
        ties = [(c, "asc") for c in best.columns if c != self.key]
        out = self.table.upsert(best, better=newer([*self.rank, *ties]))
        self._note(batch)
        return out


def advance(spark: SparkSession, root: str, bronze: dict[str, DataFrame], new: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Bring the winners of all feeds up to date; a feed without any is deduplicated in full."""
    out = {}
    for feed in silver.RANKS:
        kept = Winners(spark, root, feed)
        if not kept.exists():
            kept.rebuild(bronze[feed])
        else:
            kept.apply(kept.new_rows(bronze[feed]) if new is None else new[feed])
        out[feed] = kept.read()
    return out
