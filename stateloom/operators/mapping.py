"""Schema alignment and projections kept as data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.functions.keys import quoted

LOAD_KEY = "__load_key"
INGESTED_AT = "__ingested_at"


class MappingRow(NamedTuple):
    bank: str
    target_col: str
    expr: str


def run_stamp(run_ts: dt.datetime) -> Column:
    """The run's UTC time as a constant, one value for a whole statement."""
    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly `columns`, by case-sensitive name: absent ones are NULL text, others are dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(quoted(c)) if c in present else F.lit(None).cast("string")).alias(c)
            for c in columns
        ]
    )


def rows_for(mapping: Iterable[MappingRow], bank: str) -> list[tuple[str, str]]:
    """(target, expression) pairs of one bank in target order, cleaned of stray ends of lines."""
    pairs = [
        (row.target_col, row.expr.replace("\r", "").strip().replace(";", "")) for row in mapping if row.bank == bank
    ]
    if not pairs:
        raise ValueError(f"no mapping rows for bank {bank!r}")
    return sorted(pairs)


def mapped_projection(
    raw: DataFrame, mapping: Iterable[MappingRow], bank: str, run_ts: dt.datetime
) -> DataFrame:
    """Load key, the bank's mapped columns in name order, ingest time."""
    return raw.select(
        F.col(LOAD_KEY),
        *[F.expr(expression).alias(target) for target, expression in rows_for(mapping, bank)],
        run_stamp(run_ts).alias(INGESTED_AT),
    )
