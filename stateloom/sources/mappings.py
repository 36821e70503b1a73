"""Column mappings kept as tab-separated data."""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.operators.mapping import MappingRow

BUNDLED = Path(__file__).resolve().parent.parent / "config" / "column_map.tsv"


def bundled_mapping() -> list[MappingRow]:
    """The mapping shipped with the package, read where the driver's code lives."""
    with BUNDLED.open(encoding="utf-8", newline="") as handle:
        return [MappingRow(**row) for row in csv.DictReader(handle, delimiter="\t", quoting=csv.QUOTE_NONE)]


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A mapping file anywhere Spark can read; every column is text."""
    return (
        spark.read.option("sep", "\t").option("header", True).option("quote", "")
        .schema("bank string, target_col string, expr string").csv(path)
    )


def mapping_rows(mapping: DataFrame, bank: str) -> list[MappingRow]:
    """One bank's rows as configuration: as many as the staging table has columns."""
    rows = mapping.filter(F.col("bank") == bank).select("bank", "target_col", "expr").collect()
    return [MappingRow(*row) for row in rows]
