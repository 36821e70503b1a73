"""The display layout: renamed, reordered, everything as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.functions.cells import cell_text
from stateloom.functions.keys import quoted

# Table column -> display heading, in display order.
DISPLAY_COLUMNS = {
    "transaction_dt": "Date",
    "bank_nm": "Bank Name",
    "category_nm": "Category",
    "description": "Description",
    "transaction_amt": "Amount, Currency",
    "transaction_currency_cd": "Currency",
}


def renamed(df: DataFrame, layout: dict[str, str] | None = None) -> DataFrame:
    """The layout's columns under their headings, values untouched. A missing one is an error."""
    return df.select(*[F.col(quoted(source)).alias(heading) for source, heading in (layout or DISPLAY_COLUMNS).items()])


def stringified(df: DataFrame) -> DataFrame:
    """Every cell as display text."""
    return df.select(*[cell_text(f.name, f.dataType).alias(f.name) for f in df.schema.fields])


def display(df: DataFrame, layout: dict[str, str] | None = None) -> DataFrame:
    """The display layout; a missing source column is an error."""
    return stringified(renamed(df, layout))


def display_cells(df: DataFrame, layout: dict[str, str] | None = None) -> Column:
    """A row's cells in display order as one array of text."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.array(*[cell_text(source, kinds[source]) for source in (layout or DISPLAY_COLUMNS)])


def display_tolerant(df: DataFrame, layout: dict[str, str] | None = None) -> DataFrame:
    """The display layout by name; a missing source column is empty text, others are ignored."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (cell_text(source, kinds[source]) if source in kinds else F.lit("")).alias(heading)
            for source, heading in (layout or DISPLAY_COLUMNS).items()
        ]
    )


def header(layout: dict[str, str] | None = None) -> list[str]:
    return list((layout or DISPLAY_COLUMNS).values())


def events_export(events: DataFrame) -> DataFrame:
    """The documented export layout of an event table: its time column is named updated_at."""
    return events.withColumnRenamed("event_ts", "updated_at")
