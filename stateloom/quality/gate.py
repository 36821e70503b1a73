"""Stopping a run on failed checks or a broken schema."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateloom.quality.checks import Check, run_checks


class QualityError(RuntimeError):
    """A check of severity error failed."""


class ContractError(RuntimeError):
    """A table's names or types differ from its contract."""


def enforce(df: DataFrame, checks: Sequence[Check], table: str, stored: DataFrame | None = None) -> list[dict]:
    """Run the checks; raise on failed errors, return the failed warnings. `stored` as in `run_checks`.

    The report has one row per declared check, which is all that reaches the driver.
    """
    failed = [row.asDict() for row in run_checks(df, checks, stored).filter(~F.col("passed")).collect()]
    errors = [f for f in failed if f["severity"] == "error"]
    if errors:
        listed = ", ".join(f"{e['check_name']}({e['column_name']}): {e['failures']}" for e in errors)
        raise QualityError(f"{table}: {listed}")
    return failed


def enforce_schema(df: DataFrame, expected: str | T.StructType, table: str) -> None:
    """Names, order and types must match; nothing is read."""
    wanted = T.StructType.fromDDL(expected) if isinstance(expected, str) else expected
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in wanted.fields]
    if have != want:
        raise ContractError(f"{table}: expected {json.dumps(want)}, found {json.dumps(have)}")
