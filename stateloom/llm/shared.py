"""Folders that every executor reaches, and tables written there to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library from where the driver did."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def shared_base(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`; a local session without one gets a folder of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="stateloom-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new qualified path below the shared folder. It is removed when the application ends."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    root = f"{shared_base(spark)}/stateloom-{context.applicationId}"
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(context._jsc.hadoopConfiguration())
    fs.deleteOnExit(jvm.org.apache.hadoop.fs.Path(root))
    return fs.makeQualified(path).toString()


def kept(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back: later steps survive lost executors.

    `by`, a column of few values, deals the files out into folders: a filter on it reads only its own.
    """
    return stored(df, name, by).rows


def stored(df: DataFrame, name: str, by: str | None = None) -> Scratch:
    path = scratch(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return Scratch(df.sparkSession.read.schema(df.schema).parquet(path), path)


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """As `kept`; the shuffle files behind the table go as soon as it is written.

    For frames that nothing reads again: a second run of `df` would have to shuffle anew.
    """
    return passing(df, name, by).rows


def passing(df: DataFrame, name: str, by: str | None = None) -> Scratch:
    """As `settled`, for a table that is dropped when the next one stands."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN, "false")
    conf.set(CLEAN, "true")
    try:
        return stored(df, name, by)
    finally:
        conf.set(CLEAN, before)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@dataclass(frozen=True)
class Scratch:
    """A table that was written by `settled`, with its path, so that it can go before the application ends."""

    rows: DataFrame
    path: str

    def drop(self) -> None:
        discard(self.rows.sparkSession, self.path)


def free_name(df: DataFrame, base: str) -> str:
    """`base`, with underscores added until no column of `df` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
