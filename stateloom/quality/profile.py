"""Completeness, range and uniqueness figures, one row per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateloom.functions.keys import quoted


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count(quoted(c)).alias(f"{c}_complete") for c in columns]
    )


def metrics(df: DataFrame, complete: Sequence[str], measure: str, digits: int | None = None) -> DataFrame:
    """Completeness ratios, and mean and sample deviation of one measure, all as doubles."""
    rows = F.count(F.lit(1)).cast("double")
    # a NULL cell drops out of AVG and STDDEV, as in SQL
    value = F.col(quoted(measure)).cast("double")

    def shown(figure: Column) -> Column:
        return figure if digits is None else F.round(figure, digits)

    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[shown(F.count(quoted(c)).cast("double") / F.nullif(rows, F.lit(0.0))).alias(f"{c}_completeness") for c in complete],
        shown(F.avg(value)).alias(f"avg_{measure}"),
        shown(F.stddev_samp(value)).alias(f"{measure}_stddev"),
    )


def value_ranges(df: DataFrame, columns: Sequence[str], invalid: dict[str, Column]) -> DataFrame:
    """Smallest and largest value per column, and how many rows meet each `invalid` condition."""
    bounds = [f(quoted(c)).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return df.agg(*bounds, *[F.count_if(condition).alias(name) for name, condition in invalid.items()])


def _distinct_form(df: DataFrame, name: str) -> Column:
    # text travels through the shuffle as its SHA-256
    column = F.col(quoted(name))
    return F.sha2(column, 256) if isinstance(df.schema[name].dataType, T.StringType) else column


def uniqueness(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column beside the row count; exact unless `approximate`."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    distinct = [count(_distinct_form(df, c)).alias(f"unique_{c}") for c in columns]
    return df.agg(*distinct, F.count(F.lit(1)).alias("total_rows"))


def export_counts(df: DataFrame, amount: Column, cashback: Column) -> DataFrame:
    """What an export must hold at least one of: debits and cashback rows."""
    return df.agg(
        F.count_if(amount < 0).alias("debit_rows"), F.count_if(cashback > 0).alias("cashback_rows")
    )
