"""After a run: archive the files that were read, drop old snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.operators.keys import keyed_update
from stateloom.operators.mapping import run_stamp
from stateloom.operators.retention import KEEP_SNAPSHOTS, pending_archive, retention_plan
from stateloom.plans.warehouse import Warehouse
from stateloom.session import checkpoint
from stateloom.sinks.latest import LatestCopy
from stateloom.sinks.tables import TableStore
from stateloom.sources.files import find_files


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark resolves it to: `/data` is not on the executor's own disk on a cluster."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    inner = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return inner.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(inner).toString()


def _file_system(root: str):
    """The Arrow file system of a qualified path, and the path inside it."""
    from pyarrow import fs

    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(root, safe=":/@"))


def _moves(root: str):
    def move(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = _file_system(root)
        for batch in batches:
            outcome = []
            for source, target in zip(batch["src_path"], batch["archived_path"]):
                have, done = system.get_file_info([f"{base}/{source}", f"{base}/{target}"])
                if have.type == fs.FileType.File:
                    system.create_dir(f"{base}/{target}".rpartition("/")[0], recursive=True)
                    system.move(f"{base}/{source}", f"{base}/{target}")
                    outcome.append("archived")
                else:
                    # an earlier attempt of this task has moved it, or it is gone
                    outcome.append("archived" if done.type == fs.FileType.File else "missing")
            yield batch.assign(outcome=outcome)

    return move


def archive_files(spark: SparkSession, warehouse: Warehouse, root: str, run_ts: dt.datetime, run_id: str) -> DataFrame:
    """Move files whose ledger rows are open to the archive; returns src_path, archived_path, outcome.

    Moves run on the executors. Every ledger row of a moved path is closed, older versions of the
    file included; a missing file stays open.
    """
    ledger = warehouse.ledger_rows()
    pending = pending_archive(ledger).select("src_path", "archived_path").dropDuplicates(["src_path"])
    moved = checkpoint(
        pending.repartition(spark.sparkContext.defaultParallelism).mapInPandas(_moves(qualified(spark, root)), "src_path string, archived_path string, outcome string")
    )
    archived = moved.filter(F.col("outcome") == "archived")
    if not archived.isEmpty():
        closed = keyed_update(ledger, archived, "src_path", {"archived_at": run_stamp(run_ts)})
        warehouse.ledger().overwrite(closed, run_id)
    return moved


def snapshot_folders(spark: SparkSession, exports: str) -> DataFrame:
    """The folders right below the export folder with the newest time of any file in them."""
    below = exports.rstrip("/").rpartition("/")[2]
    path = F.split("path", f"/{below}/")
    return (
        find_files(spark, exports, "*")
        .select(F.split(F.element_at(path, -1), "/")[0].alias("folder"), F.col("modificationTime").alias("at"))
        .groupBy("folder")
        .agg(F.max("at").alias("modified_at"))
        .withColumn("dataset", F.lit(below))
    )


def prune_snapshots(spark: SparkSession, exports: str, keep: int = KEEP_SNAPSHOTS) -> dict[str, int]:
    """Delete all but the newest dated folders; there is one folder per export day."""
    plan = retention_plan(snapshot_folders(spark, exports), keep=keep)
    doomed = [row["folder"] for row in plan.filter(F.col("action") == "delete").select("folder").collect()]
    kept = plan.filter(F.col("action") == "keep").count()
    system, base = _file_system(qualified(spark, exports))
    for folder in doomed:
        system.delete_dir(f"{base}/{folder}")
    return {"deleted_count": len(doomed), "kept_count": kept}


def drop_old_copies(copy: LatestCopy, keep: int = 2) -> list[str]:
    """Delete the versions of a latest copy that no recent pointer names, what failed publishes left included."""
    system, base = _file_system(qualified(copy.spark, copy.path))
    doomed = copy.expired(keep)
    for folder in doomed:
        system.delete_dir(f"{base}/{folder}")
    return doomed


def drop_expired(store: TableStore, keep: int = 2) -> list[str]:
    """Delete the directories no recent version of a table uses; readers of the newest stay safe.

    A directory that is gone already is passed over, so an interrupted run can be repeated.
    """
    from pyarrow import fs

    system, base = _file_system(qualified(store.spark, store.path))
    dropped = []
    for folder in store.expired_dirs(keep):
        if system.get_file_info(f"{base}/{folder}").type == fs.FileType.Directory:
            system.delete_dir(f"{base}/{folder}")
            dropped.append(folder)
    return dropped
