"""Which rows a run has to look at, and how they replace what is stored."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.operators.keys import unseen

# Where the high-watermark starts on an empty table, and how far a run looks back.
EPOCH = "1900-01-02 00:00:00"
LOOKBACK = "INTERVAL 1 DAY"


def lookback_start(target: DataFrame, column: str = "__ingested_at") -> DataFrame:
    """One row: the target's newest value less the lookback, or the start of time less it."""
    newest = F.coalesce(F.max(column), F.lit(EPOCH).cast("timestamp_ntz"))
    return target.agg((newest - F.expr(LOOKBACK)).alias("since"))


def since_lookback(upstream: DataFrame, target: DataFrame, column: str = "__ingested_at") -> DataFrame:
    """Upstream rows at or after the target's high-watermark less the lookback.

    The bound is a scalar subquery: it runs first and its value reaches the upstream scan.
    """
    return upstream.filter(F.col(column) >= lookback_start(target, column).scalar())


def delete_insert(target: DataFrame, batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the whole batch as it is."""
    return unseen(target, batch, key).unionByName(batch)


def distinct_per_file(rows: DataFrame, file_column: str) -> DataFrame:
    """Full-row distinct within each file; equal rows of two files both stay."""
    if file_column not in rows.columns:
        raise ValueError(f"no column {file_column}")
    return rows.distinct()


def backfill_range(
    df: DataFrame, column: str, first: dt.date | str, last: dt.date | str, *keep: Column
) -> DataFrame:
    """Rows of the days `first` to `last`, both included, as one filter instead of a daily loop."""
    start = F.lit(str(first)).cast("timestamp_ntz")
    end = F.lit(str(last)).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    picked = df.filter((F.col(column) >= start) & (F.col(column) < end))
    return picked.select(*keep) if keep else picked


def after_bookmark(df: DataFrame, ts: str, row_id: str, last_ts: Column, last_id: Column) -> DataFrame:
    """Rows strictly after the (timestamp, id) bookmark; the first conjunct prunes the scan."""
    newer = (F.col(ts) > last_ts) | ((F.col(ts) == last_ts) & (F.col(row_id) > last_id))
    return df.filter((F.col(ts) >= last_ts) & newer)


def newest_bookmark(df: DataFrame, ts: str, row_id: str) -> DataFrame:
    """One row with the largest (timestamp, id) pair."""
    return df.agg(F.max(F.struct(F.col(ts).alias("last_ts"), F.col(row_id).alias("last_id"))).alias("mark")).select(
        "mark.last_ts", "mark.last_id"
    )
