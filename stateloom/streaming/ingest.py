"""Incremental file ingest with Structured Streaming.

The file source tells files apart by path alone, so a file whose bytes change under a known path
is not read again; the batch ingest with its (path, md5) ledger does that, and so does the stream of
`changes.py`.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stateloom.functions.keys import load_key
from stateloom.operators.incremental import LOOKBACK
from stateloom.operators.keys import unseen_in_store
from stateloom.operators.mapping import INGESTED_AT, LOAD_KEY, run_stamp
from stateloom.sinks.tables import TableStore


def statement_stream(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str],
    separator: str = ";",
    archive: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files of one header as a stream of text rows with load keys.

    With `archive`, Spark itself moves a file there, under its full path, once a later batch has
    committed. `max_files` bounds what one batch takes on.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("sep", separator)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)  # a file with another header fails instead of shifting columns
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(folder)
    return rows.withColumn(LOAD_KEY, load_key(rows, columns)).select(LOAD_KEY, *[F.col(f"`{c}`") for c in columns])


def append_unseen(
    stream: DataFrame, store: TableStore, name: str, checkpoint: str, run_ts: dt.datetime | None = None
) -> StreamingQuery:
    """Append the rows whose key the table lacks, for what is there now, then stop.

    A batch is committed to the table under the query's id and its own number, so a batch replayed
    after a failure adds nothing twice, while a new checkpoint, whose numbers begin again, has an
    id of its own. Repeated keys within one batch stay, as in the batch ingest.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        stamp = run_ts or dt.datetime.now(dt.timezone.utc)
        stored = store.read_or_none()
        fresh = batch if stored is None else unseen_in_store(batch, stored, LOAD_KEY)
        query = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
        store.append(fresh.withColumn(INGESTED_AT, run_stamp(stamp)), f"{name}-{query}-{number}")

    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def distinct_by_key(stream: DataFrame, key: str = LOAD_KEY) -> DataFrame:
    """The first row of each key, over the whole life of the stream; state grows with the keys."""
    return stream.dropDuplicates([key])


def distinct_within_lookback(stream: DataFrame, time: str, key: str = LOAD_KEY, late: str = LOOKBACK) -> DataFrame:
    """The first row of each key within the lookback; older keys leave the state.

    `time` must be a plain TIMESTAMP: watermarks do not take zone-free ones.
    """
    return stream.withWatermark(time, late.removeprefix("INTERVAL ").lower()).dropDuplicatesWithinWatermark([key])


def to_files(stream: DataFrame, folder: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Write a stream to parquet for what is there now, then stop."""
    writer = stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.outputMode("append").trigger(availableNow=True).start()
