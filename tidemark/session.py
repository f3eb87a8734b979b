"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the engine is designed for. Partition counts are left to the cluster,
# except that a stateful stream fixes its shuffle partitions on its first start.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Back-fills run many micro-batches; their metrics are summed afterwards.
    "spark.sql.streaming.numRecentProgressUpdates": "100000",
}

# For a cluster whose dedup state outgrows executor heaps: `build_session(large_state=True)`.
LARGE_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str, master: str | None = None, large_state: bool = False, **settings: str) -> SparkSession:
    """Start (or get) a session with the engine's settings; `settings` override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(LARGE_STATE_SETTINGS if large_state else {}), **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates, slots and time literals are all UTC; make the session agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Without it nothing is staged: a machine-local folder would be lost with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and return a scan of what was written.

    The result has no lineage, survives lost executors, is the same on every
    read, and lets later steps read only the columns they need. A caller that
    wants to delete it afterwards names the folder.
    """
    spark = df.sparkSession
    path = f"{folder}/{label}" if folder else fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
