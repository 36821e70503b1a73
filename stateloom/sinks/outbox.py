"""Rows due to an outside consumer: each staged once, sent under ids that never change, acknowledged by chunk.

`stage` takes the rows that were never staged before, by key and content, into a batch: the rows of one commit, cut
into chunks. From then on a chunk holds the same rows in every attempt. `deliver` sends the chunks that are not
acknowledged, from the executors. Whatever is interrupted is repeated:

* before the commit of a batch, nothing is staged and the next call finds the same rows;
* between that commit and the bookmark, the next call looks at more rows than it must, and the staged ones are left out;
* between sending and the acknowledgement, a chunk is sent again under its id. A consumer that remembers ids drops it; one
  that can be asked (an attribute `known` of the append function, from an id to whether it has it) is not sent it.

So no row is skipped, and none reaches such a consumer twice. A row whose content changes is sent again as it is now.
The bookmark only spares the scan of rows that were staged long ago; what is new is told by key and content.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.operators.keys import unseen_in_store
from stateloom.session import checkpoint
from stateloom.sinks.rows import Append
from stateloom.sinks.tables import TableStore

CHUNK_ROWS = 500
ROW_SCHEMA = "batch string, chunk string, position bigint, row_key string, digest string, stamp timestamp_ntz, cells array<string>"
# of an id that is made while rows are written: partition above, row number below
ROW_BITS = 33


class Outbox:
    """The outbox of one dataset below `path`."""

    def __init__(self, spark: SparkSession, path: str, dataset: str, chunk_rows: int = CHUNK_ROWS) -> None:
        self.spark = spark
        self.dataset = dataset
        self.chunk_rows = chunk_rows
        base = f"{path.rstrip('/')}/{dataset}"
        self.rows = TableStore(spark, f"{base}/rows")
        self.acks = TableStore(spark, f"{base}/acknowledged")
        self.marks = TableStore(spark, f"{base}/bookmark")
        self.done = TableStore(spark, f"{base}/delivered")

    # -- staging

    def bookmark(self) -> dt.datetime | None:
        """The newest stamp of all rows staged so far."""
        marks = self.marks.read_or_none()
        return None if marks is None else marks.agg(F.max("stamp")).first()[0]

    def stage(self, due: DataFrame, run_id: str) -> int:
        """Rows of `due` (row_key, stamp, cells) that were not staged before become a batch; their number.

        Rows with equal key and content are one row. A row that appears with a stamp older than the bookmark
        is not looked at: stamps must not go back, as those of a run's tables do not.
        """
        mark = self.bookmark()
        if mark is not None:  # rows of the newest stamp may still come
            due = due.filter(F.col("stamp") >= F.lit(mark.isoformat()).cast("timestamp_ntz"))
        rows = due.select("row_key", F.md5(F.to_json("cells")).alias("digest"), "stamp", "cells").dropDuplicates(["row_key", "digest"])
        staged = self.rows.read_or_none()
        fresh = rows if staged is None else unseen_in_store(rows, staged, ["row_key", "digest"])
        # evaluated once, and nothing is committed for nothing
        fresh = checkpoint(fresh)
        newest = fresh.agg(F.max("stamp").alias("stamp"), F.count(F.lit(1)).alias("n")).first()
        if not newest["n"]:
            return 0
        name = f"{run_id}-{uuid.uuid4().hex[:12]}"  # a run id may be used again
        number = F.monotonically_increasing_id()
        part, row = F.shiftright(number, ROW_BITS), number.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
        chunk = F.concat_ws("-", F.lit(self.dataset), F.lit(name), part, F.floor(row / self.chunk_rows))
        batch = fresh.select(F.lit(name).alias("batch"), chunk.alias("chunk"), row.alias("position"), "row_key", "digest", "stamp", "cells")
        added = self.rows.append(batch, name)
        self.marks.append(self.spark.createDataFrame([(newest["stamp"],)], "stamp timestamp_ntz").coalesce(1), name)
        return added

    def staged(self) -> DataFrame:
        rows = self.rows.read_or_none()
        return self.spark.createDataFrame([], ROW_SCHEMA) if rows is None else rows

    # -- delivery

    def open_batches(self) -> list[str]:
        """Batches with chunks that may still have to be sent: one name per interrupted or new run."""
        names = self.rows.commits().select(F.col("run_id").alias("batch")).distinct()
        done = self.done.read_or_none()
        return sorted(r.batch for r in (names if done is None else names.join(done.select("batch"), "batch", "left_anti")).collect())

    def pending(self, batches: Sequence[str]) -> DataFrame:
        """Rows of chunks that are not acknowledged."""
        rows = self.staged().filter(F.col("batch").isin(list(batches)))
        acknowledged = self.acks.read_or_none()
        return rows if acknowledged is None else unseen_in_store(rows, acknowledged, "chunk")

    def deliver(self, connect: Callable[[], Append], run_id: str, header: Sequence[str] | None = None) -> int:
        """Send what is pending, acknowledge it, and return the number of rows sent."""
        batches = self.open_batches()
        if not batches:
            return 0
        if header is not None and not self.done.exists():
            append = connect()
            if not known(append, f"{self.dataset}-header"):
                append(f"{self.dataset}-header", [list(header)])
        ordered = self.pending(batches).select("chunk", "position", "cells").repartition("chunk").sortWithinPartitions("chunk", "position")
        # the rows are sent while their acknowledgements are written
        attempt = f"{run_id}-{uuid.uuid4().hex[:12]}"
        self.acks.append(ordered.mapInPandas(sending(connect), "chunk string, sent bigint"), attempt)
        sent = self.acks.read_written(attempt).agg(F.sum("sent")).first()[0] or 0
        self.done.append(self.spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(1), attempt)
        return sent


def known(append: Append, chunk: str) -> bool:
    asked = getattr(append, "known", None)
    return bool(asked and asked(chunk))


def sending(connect: Callable[[], Append]):
    """Rows ordered by chunk and position to one row per chunk that the consumer has taken."""

    def send(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        append: Append | None = None
        for chunk, cells in chunks(batches):
            append = append or connect()
            if not known(append, chunk):
                append(chunk, cells)
            yield pd.DataFrame({"chunk": [chunk], "sent": [len(cells)]})

    return send


def chunks(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[str, list[list[str]]]]:
    """Whole chunks, which are no longer than what `stage` made them, across batches."""
    name, held = None, []
    for batch in batches:
        for chunk, cells in zip(batch["chunk"], batch["cells"]):
            if chunk != name:
                if held:
                    yield name, held
                name, held = chunk, []
            held.append(list(cells))
    if held:
        yield name, held
