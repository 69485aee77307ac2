"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock for timestamps, adaptive execution for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast conversion behind its size check).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where an aggregate on the join's key follows (the mart): a hot customer's join is split, its partial
    # aggregates are shuffled once more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tables are written, rewritten and staged more often than they are scanned: fewer bytes are worth more than quick packing.
    "spark.sql.parquet.compression.codec": "zstd",
    # A write of a few megabytes into thousands of day folders is bound by folders: let all cores share it.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Listing thousands of day folders: each task lists many (the default starts a task for every folder).
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ferrolake") -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own master and sizing."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


_local_scratch: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (any file system Spark reads).

    Only a local session that leaves it unset (tests) gets a temporary folder; on a cluster a machine's
    own disk would be seen by one executor only, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="ferrolake-")
        root = _local_scratch[app]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory name below the shared scratch root (Spark's writers create it)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
