"""Spark against DuckDB on the same parquet tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = rows_of(want_columns, result.fetchall())
    have = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(want_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(want_columns)}"
    if len(want) != len(have):
        return f"rows {len(have)} != {len(want)}"
    for mine, theirs in zip(have, want):
        if mine != theirs or [type(a) for a in mine] != [type(b) for b in theirs]:
            return f"{mine} != {theirs}"
    return None
