"""Parquet tables that change by whole-directory commits.

A run writes new directories and then appends one small commit listing the directories that make
up the table. A reader takes the newest commit, so it sees a run's rows all at once or not at all,
and what it reads stays as it is while the next run writes. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateloom.operators.keys import unseen

_PART = "__part"
_WHOLE = "all"
COMMIT_SCHEMA = "version bigint, run_id string, part string, dir string, table_schema string"


class Commit(NamedTuple):
    version: int
    run_id: str
    schema: T.StructType
    dirs: list[tuple[str, str]]  # (partition, directory)


class TableStore:
    """One table below `path`; `partition_by` is an SQL expression for the text (letters, digits,
    dashes) that names the directory a row goes to.

    For `upsert`, rows with equal keys must fall into equal partitions; then a run rewrites only
    the partitions its batch touches.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: str | None = None) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.partitioned = partition_by is not None
        self.partition_by = F.lit(_WHOLE) if partition_by is None else F.coalesce(F.expr(partition_by), F.lit("none"))

    # -- reading

    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMIT_SCHEMA)

    def _load(self, committed_runs: DataFrame | None = None) -> tuple[Commit | None, set[str]]:
        """The newest commit and the names of all committed runs, in one query."""
        log = self.commits()
        if committed_runs is not None:
            log = log.join(committed_runs.select("run_id").distinct(), "run_id", "left_semi")
        newest = F.col("version") == log.agg(F.max("version")).scalar()
        rows = log.filter(newest | F.col("table_schema").isNotNull()).collect()
        if not rows:
            return None, set()
        head = max((r for r in rows if r.table_schema), key=lambda r: r.version)
        dirs = [(r.part, r.dir) for r in rows if r.version == head.version and r.dir]
        schema = T.StructType.fromJson(json.loads(head.table_schema))
        return Commit(head.version, head.run_id, schema, dirs), {r.run_id for r in rows}

    def current(self, committed_runs: DataFrame | None = None) -> Commit | None:
        """The newest commit; with `committed_runs`, the newest whose run is listed there."""
        return self._load(committed_runs)[0]

    def version(self) -> int:
        """The newest commit's number, 0 before the first."""
        return self.commits().agg(F.max("version")).first()[0] or 0

    def exists(self, committed_runs: DataFrame | None = None) -> bool:
        return self.current(committed_runs) is not None

    def read(self, committed_runs: DataFrame | None = None) -> DataFrame:
        rows = self.read_or_none(committed_runs)
        if rows is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return rows

    def read_or_none(self, committed_runs: DataFrame | None = None) -> DataFrame | None:
        commit = self.current(committed_runs)
        return None if commit is None else self._frame(commit.schema, [d for _, d in commit.dirs])

    def read_written(self, run_id: str) -> DataFrame:
        """The directories the current commit took from one run: all of every partition it touched."""
        commit = self.current()
        if commit is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._frame(commit.schema, [d for _, d in commit.dirs if d.startswith(f"data/{run_id}/")])

    def read_others(self, run_id: str) -> DataFrame:
        """What the current commit holds besides the directories of one run."""
        commit = self.current()
        if commit is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._frame(commit.schema, [d for _, d in commit.dirs if not d.startswith(f"data/{run_id}/")])

    def _frame(self, schema: T.StructType, dirs: list[str]) -> DataFrame:
        if not dirs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{d}" for d in dirs])

    def expired_dirs(self, keep: int = 2) -> list[str]:
        """Directories that only commits older than the newest `keep` refer to."""
        newest = (F.col("version") > F.lit(current.version - keep)) if (current := self.current()) else F.lit(True)
        named = self.commits().filter(F.col("dir").isNotNull())
        old = named.select("dir").join(named.filter(newest).select("dir").distinct(), "dir", "left_anti")
        return sorted(r[0] for r in old.distinct().collect())

    # -- writing

    def overwrite(self, rows: DataFrame, run_id: str) -> int:
        """The table becomes `rows`. A run id used before makes another commit; nothing committed is overwritten."""
        current = self.current()
        added, count = self._write(rows, f"data/{run_id}/all")
        self._commit(current, run_id, rows.schema, added)
        return count

    def append(self, rows: DataFrame, run_id: str, committed_runs: DataFrame | None = None, again: bool = False) -> int:
        """Adds `rows`; a run that has committed already adds nothing again, unless `again`.

        With `committed_runs`, what stays is the newest version whose run is listed there.
        """
        current, runs = self._load()
        if run_id in runs and not again:
            return 0
        base = current if committed_runs is None else self.current(committed_runs)
        added, count = self._write(rows, f"data/{run_id}/new")
        self._commit(current, run_id, rows.schema, (base.dirs if base else []) + added)
        return count

    def upsert(self, batch: DataFrame, key: str, run_id: str, again: bool = False) -> int:
        """Delete and insert by key: stored rows with a key of the batch go, the whole batch comes.

        A run that has committed already changes nothing, unless `again`.

        Stored rows outside the partitions the batch touches are neither read nor rewritten.
        """
        current, runs = self._load()
        if run_id in runs and not again:
            return 0
        added, count = self._write(batch, f"data/{run_id}/batch")
        kept: list[tuple[str, str]] = []
        untouched: list[tuple[str, str]] = []
        if current is not None:
            touched = {part for part, _ in added}
            untouched = [(part, d) for part, d in current.dirs if part not in touched]
            stale = [d for part, d in current.dirs if part in touched]
            if stale:
                written = self._frame(batch.schema, [d for _, d in added])
                survivors = unseen(self._frame(current.schema, stale), written, key)
                kept, _ = self._write(survivors, f"data/{run_id}/kept")
        self._commit(current, run_id, batch.schema, untouched + kept + added)
        return count

    def _write(self, rows: DataFrame, folder: str) -> tuple[list[tuple[str, str]], int]:
        # every attempt has a folder of its own; what a failed one leaves is in no commit
        folder = f"{folder}-{uuid.uuid4().hex}"
        placed = rows.withColumn(_PART, self.partition_by)
        if self.partitioned:
            # splits a partition that holds much of the batch over several tasks and files
            placed = placed.hint("rebalance", _PART)
        placed.write.partitionBy(_PART).parquet(f"{self.path}/{folder}")
        written = self.spark.read.format("parquet").schema(f"{_PART} string").load(f"{self.path}/{folder}")
        counts = {r[_PART]: r["count"] for r in written.groupBy(_PART).count().collect()}
        return [(part, f"{folder}/{_PART}={part}") for part in sorted(counts)], sum(counts.values())

    def _commit(
        self, current: Commit | None, run_id: str, schema: T.StructType, dirs: list[tuple[str, str]]
    ) -> None:
        version = current.version + 1 if current else 1
        rows = [(version, run_id, None, None, schema.json())]
        rows += [(version, run_id, part, d, None) for part, d in dirs]
        self.spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1).write.mode("append").json(f"{self.path}/commits")


def require_table(rows: DataFrame | None, name: str) -> DataFrame:
    """Fail early when a table that a build reads from is missing."""
    if rows is None:
        raise LookupError(f"missing relation {name}")
    return rows
