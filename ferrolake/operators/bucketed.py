"""A keyed table in hash buckets, merged into without moving its stored rows.

Layout: ``data/version=N/bucket_no=B/`` holds the rows whose key hashes to bucket ``B``, written as a bucketed Spark
table (the file names carry the bucket). A manifest says which version of every bucket is current and commits a change,
as in ``PartitionedTable``: an interrupted write leaves the table as it was.

``upsert`` joins a batch with the stored rows of the buckets that the batch touches. These buckets are registered as
a bucketed table, whose scan reports the hash partitioning of the key, so the join moves the batch only: the stored side
has no exchange, and each task of the join reads, merges and writes one bucket. Untouched buckets are neither read
nor written. ``better`` says whether a batch row beats the stored row of its key; by default it always does.

The number of buckets is fixed by the first write (``spark.sql.shuffle.partitions`` unless given) and should be about
stored bytes / 256 MB. A NULL key is a key like any other: there is at most one such row.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .files import delete, exists
from .upsert import PartitionedTable, _partition_dir

BUCKET, KEY = "bucket_no", "key_hashed"


def _key(key: str | Sequence[str]) -> Column:
    """The key as one string that is never NULL: '-' for NULL, else '=' and the value."""
    keys = [key] if isinstance(key, str) else list(key)
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return parts[0] if len(parts) == 1 else F.concat_ws("\x1f", *parts)


class BucketedTable(PartitionedTable):
    """``within``: columns by which the rows of a bucket are sorted, so that their row groups cover narrow ranges."""

    def __init__(self, spark: SparkSession, path: str, key: str | Sequence[str], buckets: int | None = None, within: Sequence[str] = (KEY,)):
        super().__init__(spark, path, BUCKET)
        self.key, self._given, self.within = key, buckets, list(within)

    @property
    def buckets(self) -> int:
        spec = f"{self.path}/buckets"
        if exists(self.spark, f"{spec}/_SUCCESS"):
            return self.spark.read.parquet(spec).first()["n"]
        n = self._given or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.spark.range(1).select(F.lit(n).cast("int").alias("n")).coalesce(1).write.mode("overwrite").parquet(spec)
        return n

    def _placed(self, df: DataFrame) -> DataFrame:
        """Spark's own bucket function, so that folders, file names and join partitions agree."""
        return df.withColumn(KEY, _key(self.key)).withColumn(BUCKET, F.pmod(F.hash(KEY), F.lit(self.buckets)))

    def _store(self, df: DataFrame, path: str) -> None:
        if BUCKET not in df.columns:
            df = self._placed(df)
        name = f"ferrolake_write_{uuid.uuid4().hex[:12]}"
        (df.write.format("parquet").mode("overwrite").partitionBy(BUCKET).bucketBy(self.buckets, KEY).sortBy(*self.within)
         .option("path", path).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")   # external: the files stay

    def write(self, df: DataFrame, replaces: Sequence[str] | None = None) -> None:
        """Rows that are not yet in buckets are dealt out first: each task then writes one bucket, so a write makes as many
        files as there are buckets, however many tasks its input has."""
        super().write(df if BUCKET in df.columns else self._placed(df).repartition(self.buckets, KEY), replaces)

    def _rows(self, now: dict[str, int], only: Sequence[str] | None = None) -> DataFrame:
        return super()._rows(now, only).drop(KEY, BUCKET)

    def stored(self) -> DataFrame:
        """The committed buckets as a bucketed table (with ``bucket_no`` and the hashed key). A bucket's folder may lie
        in any version; filters on ``bucket_no`` prune the others."""
        name = self._registered(self.manifests()[-1])
        if not self.spark.catalog.tableExists(name):
            schema = self.spark.read.parquet(f"{self.path}/schema").schema
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet PARTITIONED BY ({BUCKET}) CLUSTERED BY ({KEY}) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/data/current'")
            places = [f"PARTITION ({d.replace('=', ' = ')}) LOCATION '{self.path}/data/version={v}/{d}'" for d, v in sorted(self.current().items())]
            if places:
                self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(places))
        return self.spark.table(name)

    def merged(self, batch: DataFrame, touched: Sequence[int], better: Callable[[str, str], Column] | None = None,
               combine: Callable[[str, Column, Column], Column] | None = None) -> DataFrame:
        """The touched buckets after the batch (one row per key): one join, in which only the batch moves."""
        old = self.stored().where(F.col(BUCKET).isin(list(touched))).alias("o")
        new = batch.repartition(self.buckets, KEY).alias("n")   # dealt out as the stored buckets are
        wins = F.col(f"o.{KEY}").isNull() if better is None else F.col(f"o.{KEY}").isNull() | better("n", "o")
        wins = F.col(f"n.{KEY}").isNotNull() & (F.lit(True) if better is None else wins)

        def value(c: str) -> Column:
            a, b = F.col(f"n.`{c}`"), F.col(f"o.`{c}`")
            if combine is not None:
                return F.coalesce(a, b) if c in (KEY, BUCKET) else combine(c, a, b)
            return F.when(wins, a).otherwise(b)

        cols = [value(c).alias(c) for c in self.stored().columns]
        return old.join(new, F.col(f"o.{KEY}") == F.col(f"n.{KEY}"), "full_outer").select(*cols)

    def upsert(self, source: DataFrame, key: str | None = None, better: Callable[[str, str], Column] | None = None,
               combine: Callable[[str, Column, Column], Column] | None = None) -> list[str]:
        """Merge ``source`` (one row per key), stored once first; returns the rewritten buckets. ``combine(name, new, stored)``
        gives the merged value of a column where a row is not replaced as a whole (either side may be NULL)."""
        if not self.exists():
            self.write(source)
            return sorted(self.current())
        stage = scratch_path(self.spark, "upsert-stage")
        self._placed(source).write.parquet(stage)
        batch = self.spark.read.parquet(stage)
        touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())   # at most one number per bucket
        out = [_partition_dir(BUCKET, b) for b in touched]
        if touched:
            self.write(self.merged(batch, touched, better, combine), replaces=out)
        delete(self.spark, stage)
        return out

    def vacuum(self, keep: int = 2, pinned: str | None = None) -> None:
        before = self.manifests()
        super().vacuum(keep, pinned)
        for name in set(before) - set(self.manifests()):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._registered(name)}")

    def _registered(self, manifest: str) -> str:
        return f"ferrolake_{hashlib.md5(self.path.encode()).hexdigest()[:16]}_{manifest}"


def newer(order: Sequence[tuple[str, str]]) -> Callable[[str, str], Column]:
    """Whether row ``a`` comes before row ``b`` in an order of (column, 'desc' or 'asc') as ``keep_latest`` sorts:
    descending columns with NULLs last, ascending ones with NULLs first. Equal rows: the stored one stays."""

    def better(a: str, b: str) -> Column:
        out = F.lit(False)
        for name, way in reversed(order):
            x, y = F.col(f"{a}.`{name}`"), F.col(f"{b}.`{name}`")
            if way == "desc":
                first, last = x.isNotNull() & (y.isNull() | (x > y)), y.isNotNull() & (x.isNull() | (y > x))
            else:
                first, last = y.isNotNull() & (x.isNull() | (x < y)), x.isNotNull() & (y.isNull() | (y < x))
            out = F.when(F.coalesce(first, F.lit(False)), True).when(F.coalesce(last, F.lit(False)), False).otherwise(out)
        return out

    return better
