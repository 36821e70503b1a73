"""Header records: column names."""

from __future__ import annotations

import csv

from pyspark.sql import Column
from pyspark.sql import functions as F

from stateloom.sources.dialects import Dialect


def clean_header(header: Column) -> Column:
    """The header line without a byte-order mark and the carriage return."""
    return F.regexp_replace(header, "^﻿|\r$", "")


def column_names(header: str, dialect: Dialect) -> list[str]:
    """Names as the file gives them; a blank one is named by position, a repeated one numbered."""
    separator, quote, escape = dialect
    if quote and escape == quote and header.count(quote) % 2:
        raise ValueError(f"the header does not end: {header[:80]!r}")
    reader = csv.reader(
        [header], delimiter=separator, quotechar=quote or None, doublequote=escape == quote, escapechar=escape if escape not in ("", quote) else None,
        quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE,
    )
    names: list[str] = []
    taken: set[str] = set()
    for position, name in enumerate(next(reader, [])):
        base = name or f"column{position}"
        candidate, number = base, 0
        while candidate.lower() in taken:
            number += 1
            candidate = f"{base}_{number}"
        taken.add(candidate.lower())
        names.append(candidate)
    return names
