"""Deterministic row keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateloom.functions.text import double_text, double_text_sql

NULL_TAG = "<NULL>"
NO_CARD = "no_card_last4"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text_sql(df: DataFrame, name: str) -> str:
    """A column as the text that goes into a hash."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return quoted(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return double_text_sql(f"cast({quoted(name)} AS double)")
    return f"cast({quoted(name)} AS string)"


def load_key(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """md5 over the columns in name order, each as `length:value` so that no value can pose as two."""
    pieces = []
    for name in sorted(columns if columns is not None else df.columns):
        value = f"coalesce({_text_sql(df, name)}, '{NULL_TAG}')"
        pieces.append(f"concat(length({value}), ':', {value})")
    return F.expr(f"md5(concat_ws('|', {', '.join(pieces)}))")


def business_key(source: str, occurred_at: str, amount: str, card: str) -> Column:
    """md5 naming one transaction: source, UTC time, amount and card; a NULL part is left out.

    The parts are column names or SQL expressions.
    """
    return F.md5(
        F.concat_ws(
            "|",
            F.lit(source),
            F.expr(f"cast({occurred_at} AS string)"),
            double_text(amount),
            F.expr(f"coalesce({card}, '{NO_CARD}')"),
        )
    )
