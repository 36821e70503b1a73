"""Checks as data, evaluated together.

All row-wise checks of a table share one aggregation over one scan; each uniqueness check adds one
grouping by its key, which combines map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.functions.keys import quoted
from stateloom.quality.uniqueness import failures_after

REPORT_COLUMNS = ("check_name", "column_name", "severity", "failures", "passed")


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    severity: str = "error"
    values: tuple[Any, ...] | None = None
    low: Any = None
    high: Any = None
    rule: str | None = None

    def __post_init__(self) -> None:
        if self.severity not in ("error", "warn"):
            raise ValueError(f"unknown severity {self.severity!r}")

    def broken(self) -> Column:
        """Whether a row breaks the check. NULL passes everything but not_null."""
        value = F.col(quoted(self.column)) if self.kind != "rule" else None
        if self.kind == "not_null":
            return value.isNull()
        if self.kind in ("accepted_values", "in_set"):
            return value.isNotNull() & ~value.isin(*self.values)
        if self.kind == "between":
            too_low = F.lit(False) if self.low is None else value < F.lit(self.low)
            too_high = F.lit(False) if self.high is None else value > F.lit(self.high)
            return F.coalesce(too_low | too_high, F.lit(False))
        if self.kind == "rule":
            return ~F.coalesce(F.expr(self.rule), F.lit(True))
        raise ValueError(f"{self.kind} is not a row-wise check")


def not_null(column: str, severity: str = "error") -> Check:
    return Check("not_null", column, severity)


def unique(column: str, severity: str = "error") -> Check:
    return Check("unique", column, severity)


def accepted_values(column: str, values: Sequence[Any], severity: str = "error") -> Check:
    return Check("accepted_values", column, severity, values=tuple(values))


def in_set(column: str, values: Sequence[Any], severity: str = "error") -> Check:
    return Check("in_set", column, severity, values=tuple(values))


def between(column: str, low: Any = None, high: Any = None, severity: str = "error") -> Check:
    return Check("between", column, severity, low=low, high=high)


def column_exists(column: str, severity: str = "error") -> Check:
    return Check("exists", column, severity)


def row_rule(name: str, rule: str, severity: str = "error") -> Check:
    """A boolean SQL expression that must hold on every row; an unknown result passes."""
    return Check("rule", name, severity, rule=rule)


def run_checks(df: DataFrame, checks: Sequence[Check], stored: DataFrame | None = None) -> DataFrame:
    """One row per check: name, column, severity, failures, passed.

    `failures` counts rows for row-wise checks, keys for unique, and is 0 or 1 for exists. With `stored`, `df` is
    what has been added to it: unique counts the keys that the added rows have made duplicates.
    """
    present = set(df.columns)
    reports: list[DataFrame] = []
    spread = [c for c in checks if c.kind != "unique"]
    if spread:
        entries = []
        for check in spread:
            if check.kind == "exists":
                failures = F.lit(0 if check.column in present else 1).cast("bigint")
            else:
                failures = F.count_if(check.broken())
            entries.append(_entry(check, failures))
        reports.append(df.agg(F.array(*entries).alias("entries")).select(F.inline("entries")))
    for check in checks:
        if check.kind == "unique":
            if stored is None:
                counted = duplicate_keys(df, check.column).agg(F.count(F.lit(1)).alias("failures"))
            else:
                counted = failures_after(df, stored, check.column)
            reports.append(counted.select(F.array(_entry(check, F.col("failures"))).alias("entries")).select(F.inline("entries")))
    if not reports:
        raise ValueError("no checks")
    return reduce(DataFrame.unionByName, reports).withColumn("passed", F.col("failures") == 0)


def _entry(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
    )


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once, with their counts; NULL is not a key."""
    return (
        df.filter(F.col(quoted(column)).isNotNull())
        .groupBy(F.col(quoted(column)))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def rejected_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Values outside the accepted set with their counts; NULL is accepted."""
    return (
        df.filter(F.col(quoted(column)).isNotNull() & ~F.col(quoted(column)).isin(*values))
        .groupBy(F.col(quoted(column)).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: its name and how many rows have no value; one scan for all of them."""
    names = list(columns or df.columns)
    entries = F.array(
        *[F.struct(F.lit(n).alias("column_name"), F.count_if(F.col(quoted(n)).isNull()).alias("null_rows")) for n in names]
    )
    return df.agg(entries.alias("entries")).select(F.inline("entries"))
