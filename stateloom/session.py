"""Spark session defaults and the checkpoint location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Set only where the launcher has not set them already (see `build_session`).
DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where that costs one more exchange later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # state of streams outgrows the heap; streams with timers take no other store
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app: str = "stateloom", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the library's defaults; launcher settings and `conf` win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    launched = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if key not in (conf or {}) and not launched.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name where every executor can write, below the session's `spark.checkpoint.dir`."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="stateloom-shared-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return f"{configured.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder, so a lost executor costs no recompute.

    The folder is the session's `spark.checkpoint.dir`. Only a local session without one gets a
    folder of its own; on a cluster the missing setting is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        configured = context.getConf().get("spark.checkpoint.dir")
        if configured is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="stateloom-checkpoint-"))
    return df.checkpoint()
