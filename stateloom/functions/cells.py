"""Any value as display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateloom.functions.keys import quoted
from stateloom.functions.text import double_text

NULL_CELL = "None"


def cell_text(name: str, kind: T.DataType) -> Column:
    """A column's value as text.

    Dates and timestamps in ISO form, numbers plain, NULL as the word None.
    """
    column = F.col(quoted(name))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        # via the plain text form, which for zone-free values involves no session zone
        plain = column.cast("string")
        micros = F.rpad(F.substring_index(plain, ".", -1), 6, "0")
        whole = F.replace(F.substring_index(plain, ".", 1), F.lit(" "), F.lit("T"))
        text = F.when(F.contains(plain, F.lit(".")), F.concat(whole, F.lit("."), micros)).otherwise(whole)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        text = double_text(f"cast({quoted(name)} AS double)")
    elif isinstance(kind, T.BooleanType):
        text = F.initcap(column.cast("string"))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(NULL_CELL))
