"""Setting aside rows whose text will not convert, instead of stopping on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.functions.keys import quoted
from stateloom.functions.text import comma_decimal


def bad_amount(text: Column) -> Column:
    return text.isNotNull() & comma_decimal(text, lenient=True).isNull()


def missing(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def with_problems(df: DataFrame, amounts: Sequence[str] = (), required: Sequence[str] = ()) -> DataFrame:
    """Adds `problems`: the names of the row's broken columns, comma-separated, empty when sound."""
    found = [F.when(bad_amount(F.col(quoted(c))), F.lit(c)) for c in amounts]
    found += [F.when(missing(F.col(quoted(c))), F.lit(c)) for c in required]
    return df.withColumn("problems", F.concat_ws(",", *found))


def split(df: DataFrame, amounts: Sequence[str] = (), required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(sound rows, set-aside rows with their problems)."""
    marked = with_problems(df, amounts, required)
    sound = F.col("problems") == ""
    return marked.filter(sound).drop("problems"), marked.filter(~sound)
