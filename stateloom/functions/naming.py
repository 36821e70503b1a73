"""Folder names to table names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_identifier(text: Column) -> Column:
    """Lower-case ASCII letters, digits and single underscores; `unknown` when nothing is left."""
    joined = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_")
    bare = F.trim(joined, F.lit("_"))
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit("unknown"))
