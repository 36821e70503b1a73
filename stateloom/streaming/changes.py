"""New and changed files as a stream, and the ingest that it drives.

Spark's own file source tells files apart by path and never reads one again whose bytes change. This source tells
them apart by path, time and size. Each batch of files is written to a log before Spark hears of it, and an offset
is a number of that log: a batch that is planned again after a failure has the same files, and a restarted query
goes on behind the last one. Tasks read the files for md5, header and dialect; the ledger of (path, md5) then decides, as
in the batch ingest, so a file that was only touched is not loaded again.

The listing is one entry per file, in the driver as with Spark's source. A file that is rewritten with the same size
within the store's resolution of times cannot be told from the listing; the batch ingest, which reads all bytes, does. Files
that have not rested for `settleSeconds` wait for a later batch. A file that is gone when its batch runs is passed over.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from stateloom.plans.ingest import ingest_files
from stateloom.plans.upkeep import qualified
from stateloom.plans.warehouse import Warehouse
from stateloom.sources.digests import Scanned, scan_file
from stateloom.sources.files import INBOX_PATH, SETTLE_SECONDS, placed

CHANGE_SCHEMA = (
    "path string, modificationTime timestamp_ltz, size bigint, md5 string, header string, separator string, quote string, escape string, quoted_breaks boolean"
)
FILES_PER_TASK = 32


class Listed(InputPartition):
    """Some files of a batch: (path, time in microseconds, size)."""

    def __init__(self, files: list[list]) -> None:
        self.files = files


def file_system(root: str):
    """The Arrow file system of a qualified folder, the folder inside it, and what Spark's paths have before that."""
    from pyarrow import fs

    if root.startswith("file:"):
        inner = "/" + root.removeprefix("file:").lstrip("/")
        return fs.LocalFileSystem(), inner, "file:"
    system, inner = fs.FileSystem.from_uri(quote(root, safe=":/@"))
    return system, inner, root[: len(root) - len(inner)]


class ChangeReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.log = options["path"], options["log"]
        self.suffix = options.get("suffix", ".csv")
        self.settle = float(options.get("settleseconds", SETTLE_SECONDS))
        self.most = int(options.get("maxfiles", 0))

    # -- the log

    def batches(self) -> dict[int, list[list]]:
        from pyarrow import fs

        system, base, _ = file_system(self.log)
        found = {}
        for info in system.get_file_info(fs.FileSelector(base, allow_not_found=True)):
            if info.base_name.removesuffix(".json").isdigit():
                with system.open_input_stream(info.path) as stream:
                    found[int(info.base_name.removesuffix(".json"))] = json.loads(stream.read())
        return found

    def add(self, number: int, files: list[list]) -> None:
        """One file, which appears whole: it is renamed, or put in one piece by stores that do not rename."""
        system, base, _ = file_system(self.log)
        system.create_dir(base, recursive=True)
        with system.open_output_stream(f"{base}/{number}.json.part") as stream:
            stream.write(json.dumps(files).encode())
        system.move(f"{base}/{number}.json.part", f"{base}/{number}.json")

    def listing(self) -> list[list]:
        from pyarrow import fs

        system, base, prefix = file_system(self.folder)
        rested = dt.datetime.now(dt.timezone.utc).timestamp() - self.settle
        infos = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        return sorted(
            [prefix + i.path, i.mtime_ns // 1000, i.size]
            for i in infos
            if i.type == fs.FileType.File and i.base_name.endswith(self.suffix) and i.size > 0 and i.mtime_ns / 1e9 <= rested
        )

    # -- what Spark asks for

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self, *_) -> dict:
        planned = self.batches()
        last = max(planned, default=0)
        seen = {path: (at, size) for number in sorted(planned) for path, at, size in planned[number]}
        new = [f for f in self.listing() if seen.get(f[0]) != (f[1], f[2])]
        if not new:
            return {"batch": last}
        self.add(last + 1, new[: self.most] if self.most else new)
        return {"batch": last + 1}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        planned = self.batches()
        # a file that changed between two batches of one read is read once
        files = {f[0]: f for number in range(start["batch"] + 1, end["batch"] + 1) for f in planned.get(number, [])}
        ordered = sorted(files.values())
        return [Listed(ordered[i : i + FILES_PER_TASK]) for i in range(0, len(ordered), FILES_PER_TASK)]

    def read(self, partition: Listed) -> Iterator[tuple]:
        for path, at, size in partition.files:
            try:
                scanned: Scanned = scan_file(path)
            except FileNotFoundError:
                continue
            yield (path, dt.datetime.fromtimestamp(at / 1e6, dt.timezone.utc), size, *scanned)

    def commit(self, end: dict) -> None:
        """Nothing to do: the log says what was planned, Spark's checkpoint what was done."""


class FileChanges(DataSource):
    """Options: path and log (qualified folders), suffix, settleSeconds, maxFiles (of one batch)."""

    @classmethod
    def name(cls) -> str:
        return "file_changes"

    def schema(self) -> str:
        return CHANGE_SCHEMA

    def streamReader(self, schema) -> ChangeReader:
        return ChangeReader({k.lower(): v for k, v in self.options.items()})


def changed_files(
    spark: SparkSession, folder: str, checkpoint: str, settle_seconds: float = SETTLE_SECONDS, max_files: int | None = None
) -> DataFrame:
    """New and changed files below a folder with digest, header and dialect, as a stream."""
    spark.dataSource.register(FileChanges)
    reader = spark.readStream.format("file_changes").option("path", qualified(spark, folder))
    reader = reader.option("log", f"{qualified(spark, checkpoint)}/listed").option("settleSeconds", settle_seconds)
    return (reader if max_files is None else reader.option("maxFiles", max_files)).load()


def ingest_changes(
    spark: SparkSession, warehouse: Warehouse, root: str, checkpoint: str, run_ts: dt.datetime | None = None,
    settle_seconds: float = SETTLE_SECONDS, max_files: int | None = None, mode: str = "FAILFAST",
) -> StreamingQuery:
    """Load what is new or changed now into raw tables and ledger, then stop; the next call goes on from there.

    After a failure the next call runs the failed batch again, with the files it had, and leaves later ones to
    the call after it; files that were loaded before the failure are in the ledger and not loaded again.
    """

    def load(batch: DataFrame, number: int) -> None:
        stamp = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=1)  # the source has waited for files to rest
        ingest_files(spark, warehouse, placed(batch, root), stamp, f"changes-{number}", later, mode)

    stream = changed_files(spark, f"{root.rstrip('/')}/{INBOX_PATH}", checkpoint, settle_seconds, max_files)
    writer = stream.writeStream.queryName("ingest_changes").option("checkpointLocation", f"{checkpoint.rstrip('/')}/query")
    return writer.trigger(availableNow=True).foreachBatch(load).start()
