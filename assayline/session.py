"""Session settings the jobs are tuned for, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Run-time re-planning: small shuffles coalesce, oversized join and rebalance
    # partitions split, a join side that turns out small is broadcast.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A bad cast must fail the job, not turn into NULL.
    "spark.sql.ansi.enabled": "true",
    # Event times are zone-free; only the streaming watermark needs a zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.compression.codec": "snappy",
    # One run compiles more stages than the default cache of 100 keeps; evicted code is
    # compiled and warmed up again.
    "spark.sql.codegen.cache.maxEntries": "1000",
    # Deduplication state lives on disk, so it is not bounded by executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "assayline", master: str | None = None, **extra: str) -> SparkSession:
    """A tuned session. On a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the cluster's shared folder (spark.checkpoint.dir).

    Only a local master, where driver and executors share one disk, may fall back to
    a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="assayline-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
