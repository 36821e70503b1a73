"""Exporting only what is newer than the last export."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom.operators.incremental import after_bookmark, newest_bookmark
from stateloom.session import checkpoint
from stateloom.sinks.tables import TableStore

BOOKMARK_SCHEMA = "dataset string, last_ts timestamp_ntz, last_id bigint"


def bookmark_of(store: TableStore, dataset: str) -> tuple[dt.datetime, int] | None:
    rows = store.read_or_none()
    row = None if rows is None else rows.filter(F.col("dataset") == dataset).first()
    return None if row is None else (row["last_ts"], row["last_id"])


def delta(df: DataFrame, store: TableStore, dataset: str, ts: str, row_id: str) -> DataFrame:
    """Rows newer than the dataset's bookmark; all of them when it has none."""
    mark = bookmark_of(store, dataset)
    if mark is None:
        return df
    return after_bookmark(df, ts, row_id, F.lit(mark[0].isoformat()).cast("timestamp_ntz"), F.lit(mark[1]))


def export_delta(
    df: DataFrame, store: TableStore, dataset: str, ts: str, row_id: str, run_id: str,
    send: Callable[[DataFrame], object],
) -> int:
    """Send the newer rows, and move the bookmark only once `send` has returned."""
    # evaluated once: rows that arrive while the export runs stay for the next one
    newer = checkpoint(delta(df, store, dataset, ts, row_id))
    top = newest_bookmark(newer, ts, row_id).first()
    if top["last_ts"] is None:
        return 0
    send(newer)
    mark = df.sparkSession.createDataFrame([(dataset, top["last_ts"], top["last_id"])], BOOKMARK_SCHEMA)
    store.upsert(mark, "dataset", f"{run_id}-{dataset}")
    return newer.count()


def reset(store: TableStore, run_id: str, column: str, value: str) -> None:
    """Forget the rows of a state table whose `column` equals `value`, to replay them."""
    rows = store.read()
    store.overwrite(rows.filter(~F.col(column).eqNullSafe(F.lit(value))), run_id)
