"""Keyed upsert of Parquet tables without a table format (no MERGE INTO on plain Parquet).

``merge(target, source, key)`` is the relational core: replace matched keys, insert the rest, no
delete clause. NULL source keys never match, so they are dropped (``not_null`` reports them).
It is idempotent: merging the same source twice gives the same table.

Two ways to store the result. Both change nothing for readers until a marker is written last, so
they are safe to rerun after a lost executor or driver:

* ``VersionedTable``: each write goes to a new version directory; readers take the newest version
  that holds a ``_SUCCESS`` marker. Overwriting a path that is being read is never needed.
* ``PartitionedTable``: a table partitioned by a column (the fact by ``order_date``). Rewritten
  partitions go to a new version folder; a small manifest that says which version holds which
  partition is written last and commits the change. Readers follow the newest committed manifest, so
  an interrupted write leaves the table as it was and is simply run again. ``upsert`` rewrites only
  the partitions holding a matched old row or a new row; an order whose date changes leaves its old
  partition, and untouched partitions are never read or rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .files import delete, exists, list_dirs
from .layout import clustered_write, partitioned_write


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def merge(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = _keys(key)
    src = source.where(F.greatest(*[F.col(k).isNull() for k in keys]) == F.lit(False)) if len(keys) > 1 \
        else source.where(F.col(keys[0]).isNotNull())
    kept = target.join(src.select(*keys), keys, "left_anti")
    return kept.unionByName(src.select(*target.columns))


# ---------------------------------------------------------------- versioned table

class VersionedTable:
    """A directory of immutable versions ``v000001, v000002, ...``; the newest committed one is current."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def versions(self) -> list[str]:
        out = []
        for name in list_dirs(self.spark, self.path):
            if name.startswith("v") and exists(self.spark, f"{self.path}/{name}/_SUCCESS"):
                out.append(name)
        return out

    def current_path(self) -> str | None:
        v = self.versions()
        return f"{self.path}/{v[-1]}" if v else None

    def read(self) -> DataFrame | None:
        cur = self.current_path()
        return self.spark.read.parquet(cur) if cur else None

    def write(self, df: DataFrame, partition_by: Sequence[str] = (), cluster: Sequence[str] = ()) -> str:
        names = [n for n in list_dirs(self.spark, self.path) if n.startswith("v")]
        nxt = (int(names[-1][1:]) + 1) if names else 1
        out = f"{self.path}/v{nxt:06d}"
        if cluster:
            clustered_write(df, out, cluster)
            return out
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(out)
        return out

    def version(self, name: str | None) -> DataFrame | None:
        """One committed version by name; None if there is no such version."""
        return self.spark.read.parquet(f"{self.path}/{name}") if name in self.versions() else None

    def vacuum(self, keep: int = 2, pinned: str | None = None) -> list[str]:
        """Delete all but the newest ``keep`` committed versions and ``pinned`` (and unfinished older attempts)."""
        committed = self.versions()
        if len(committed) <= keep:
            return []
        cutoff = committed[-keep]
        gone = [n for n in list_dirs(self.spark, self.path) if n.startswith("v") and n < cutoff and n != pinned]
        for n in gone:
            delete(self.spark, f"{self.path}/{n}")
        return gone

    def upsert(self, source: DataFrame, key: str | Sequence[str], partition_by: Sequence[str] = ()) -> str:
        """Full mode when the table is empty, else merge into a new version."""
        current = self.read()
        new = source if current is None else merge(current, source, key)
        return self.write(new, partition_by)


# ---------------------------------------------------------------- partitioned table

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class PartitionedTable:
    """Parquet partitions below ``data/version=N/<column>=<value>`` and manifests of what is current.

    A manifest is a list of (partition folder, version): one row per partition, so its size is bounded
    by their number (days), not by the data. It is a Parquet folder whose ``_SUCCESS`` marker commits it.
    """

    def __init__(self, spark: SparkSession, path: str, partition_col: str, cluster: Sequence[str] = ()):
        self.spark, self.path = spark, path.rstrip("/")
        self.partition_col, self.cluster = partition_col, list(cluster)

    def manifests(self) -> list[str]:
        names = list_dirs(self.spark, f"{self.path}/manifests")
        return [n for n in names if exists(self.spark, f"{self.path}/manifests/{n}/_SUCCESS")]

    def _manifest(self, name: str) -> dict[str, int]:
        rows = self.spark.read.schema("partition string, version long").parquet(f"{self.path}/manifests/{name}").collect()
        return {r["partition"]: r["version"] for r in rows}

    def current(self) -> dict[str, int] | None:
        """Partition folder -> version as last committed; None for a table never written."""
        names = self.manifests()
        return self._manifest(names[-1]) if names else None

    def exists(self) -> bool:
        return bool(self.manifests())

    def partitions(self) -> list[str]:
        """Committed partition values (the default partition left out)."""
        names = [d.split("=", 1)[1] for d in (self.current() or {})]
        return sorted(n for n in names if n != _NULL_PARTITION)

    def versions(self) -> list[str]:
        return self.manifests()

    def version(self, name: str | None, only: Sequence[str] | None = None) -> DataFrame | None:
        """The rows as one manifest committed them; None if there is no such manifest."""
        return self._rows(self._manifest(name), only) if name in self.manifests() else None

    def changed_since(self, name: str) -> list[str]:
        """Partition folders that were rewritten, added or dropped after a manifest."""
        then, now = self._manifest(name), self.current() or {}
        return sorted(d for d in then.keys() | now.keys() if then.get(d) != now.get(d))

    def read(self, only: Sequence[str] | None = None) -> DataFrame | None:
        """The committed rows (of the given partition folders only)."""
        now = self.current()
        return None if now is None else self._rows(now, only)

    def _rows(self, now: dict[str, int], only: Sequence[str] | None = None) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/schema").schema
        paths = [f"{self.path}/data/version={v}/{d}" for d, v in sorted(now.items()) if only is None or d in only]
        if not paths:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("version", T.LongType())])
        return self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*paths).select(*schema.names)

    def _next(self) -> int:
        used = [int(n.split("=")[1]) for n in list_dirs(self.spark, f"{self.path}/data") if n.startswith("version=")]
        return max(used, default=0) + 1

    def write(self, df: DataFrame, replaces: Sequence[str] | None = None) -> None:
        """Store ``df`` as a new version. It takes the place of the partition folders in ``replaces``, or of the
        whole table if that is None; until the manifest is committed nothing changes for readers."""
        now = {} if replaces is None else self.current() or {}
        version = self._next()
        if not exists(self.spark, f"{self.path}/schema/_SUCCESS"):
            df.limit(0).write.mode("overwrite").parquet(f"{self.path}/schema")
        self._store(df, f"{self.path}/data/version={version}")
        kept = {d: v for d, v in now.items() if d not in set(replaces or ())}
        new = {d: version for d in list_dirs(self.spark, f"{self.path}/data/version={version}") if "=" in d}
        rows = sorted({**kept, **new}.items())
        (self.spark.createDataFrame(rows, "partition string, version long").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/manifests/m{version:08d}"))

    def _store(self, df: DataFrame, path: str) -> None:
        partitioned_write(df, path, self.partition_col, cluster=self.cluster)

    def upsert(self, source: DataFrame, key: str) -> list[str]:
        """Merge ``source`` by ``key``; returns the rewritten partition folders.

        1. The source is stored once; all later steps read that copy.
        2. Touched partitions: those of target rows whose key is in the source (a key-only scan that grows
           with the table, as any merge's does) and the source's own. They are collected: metadata, bounded by
           the number of partitions.
        3. Old rows of those partitions only are merged with the source and written, clustered, as a new version.
        """
        source, target = source.where(F.col(key).isNotNull()), self.read()
        if target is None:   # the first write stores its input once by itself
            self.write(source)
            return sorted(self.current())
        stage = scratch_path(self.spark, "upsert-stage")
        source.write.parquet(stage)
        src = self.spark.read.parquet(stage).select(*target.columns)
        col = self.partition_col
        moved = target.select(key, col).join(src.select(key), key, "left_semi").select(col)
        touched = [_partition_dir(col, r[0]) for r in moved.unionByName(src.select(col)).distinct().collect()]
        if touched:
            self.write(merge(self.read(touched), src, key), replaces=touched)
        delete(self.spark, stage)
        return touched

    def vacuum(self, keep: int = 2, pinned: str | None = None) -> None:
        """Delete manifests but the newest ``keep`` and ``pinned``, and versions and partitions that none of those names."""
        names = [n for i, n in enumerate(reversed(self.manifests())) if i < keep or n == pinned][::-1]
        used = {(v, d) for n in names for d, v in self._manifest(n).items()}
        for n in list_dirs(self.spark, f"{self.path}/manifests"):
            if names and n < names[-1] and n not in names:
                delete(self.spark, f"{self.path}/manifests/{n}")
        last = int(names[-1][1:]) if names else 0
        for folder in list_dirs(self.spark, f"{self.path}/data"):
            version = int(folder.split("=")[1])
            if version > last:
                continue  # a write that may be under way
            live = {d for v, d in used if v == version}
            if not live:
                delete(self.spark, f"{self.path}/data/{folder}")
                continue
            for d in list_dirs(self.spark, f"{self.path}/data/{folder}"):
                if "=" in d and d not in live:
                    delete(self.spark, f"{self.path}/data/{folder}/{d}")


def _partition_dir(col: str, value: object) -> str:
    return f"{col}={value if value is not None else _NULL_PARTITION}"
