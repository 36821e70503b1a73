"""Delimited files as text rows with load keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateloom.functions.keys import load_key
from stateloom.operators.incremental import distinct_per_file
from stateloom.operators.mapping import LOAD_KEY, align
from stateloom.sources.dialects import Dialect
from stateloom.sources.headers import clean_header, column_names

_FILE = "__file"


class NewFile(NamedTuple):
    path: str
    src_path: str
    header: str
    dialect: Dialect
    quoted_breaks: bool


def new_files(classified: DataFrame, table_name: str) -> list[NewFile]:
    """The new files of one table, by path: the list the reader needs, one short entry per file."""
    header = clean_header(F.col("header"))
    rows = (
        classified.filter((F.col("state") == "new") & (F.col("table_name") == table_name))
        .select("path", "src_path", header.alias("header"), F.struct("separator", "quote", "escape").alias("dialect"), "quoted_breaks")
        .toLocalIterator()
    )
    return sorted((NewFile(r.path, r.src_path, r.header, Dialect(*r.dialect), r.quoted_breaks) for r in rows), key=lambda f: f.src_path)


def table_columns(files: Sequence[NewFile]) -> list[str]:
    """The first non-empty file, in path order, sets the table's columns."""
    for file in files:
        if file.header:
            return column_names(file.header, file.dialect)
    return []


def read_group(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str], dialect: Dialect, multi_line: bool,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Files with one and the same header, every column text, plus the file each row came from."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", dialect.separator)
        .option("quote", dialect.quote)
        .option("escape", dialect.escape or "\\")
        .option("multiLine", multi_line)
        .option("mode", mode)
        .option("encoding", "UTF-8")
    )
    return reader.csv(list(paths)).select("*", F.col("_metadata.file_path").alias(_FILE))


def read_statements(
    spark: SparkSession, files: Iterable[NewFile], target: Sequence[str] | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """Load key and the table's data columns, distinct within each file.

    Files are read per (header, dialect, line breaks) signature, not one by one: Spark binds
    columns of a multi-file read by position, so files whose headers differ must not share a read.
    A key covers the columns of the row's own file, extra ones included.
    """
    files = list(files)
    target = list(target) if target is not None else table_columns(files)
    groups: dict[tuple[str, Dialect, bool], list[str]] = {}
    for file in files:
        if file.header:
            groups.setdefault((file.header, file.dialect, file.quoted_breaks), []).append(file.path)
    frames = []
    for (header, dialect, breaks), paths in groups.items():
        columns = column_names(header, dialect)
        rows = read_group(spark, paths, columns, dialect, breaks, mode)
        keyed = rows.withColumn(LOAD_KEY, load_key(rows, columns))
        frames.append(align(keyed, [LOAD_KEY, *target, _FILE]))
    if not frames:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [LOAD_KEY, *target]])
        return spark.createDataFrame([], schema)
    return distinct_per_file(reduce(DataFrame.unionByName, frames), _FILE).drop(_FILE)
