"""Finding statement files and telling new ones from known ones."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.functions.naming import normalize_identifier
from stateloom.operators.keys import distinct_keys
from stateloom.sources.digests import scan_batches

# Where banks drop their exports, and how long a file must have rested.
INBOX_PATH = "To Parse/Bank"
SETTLE_SECONDS = 8

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def find_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """All files below a folder. `content` costs nothing until a query selects it."""
    try:
        return (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .load(folder)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_SCHEMA)


def _below(path: Column, root: str) -> Column:
    plain = re.sub(r"^[a-z0-9+.-]+:(//[^/]*)?", "", root, flags=re.IGNORECASE).rstrip("/") + "/"
    return F.expr(f"substring(path, instr(path, '{_sql_text(plain)}') + {len(plain)})")


def _sql_text(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def statement_files(spark: SparkSession, root: str, any_case: bool = False) -> DataFrame:
    """Files at <root>/To Parse/Bank/<bank>/<type>/**, with bank, table and path below the root.

    Only `.csv` in lower case counts unless `any_case`.
    """
    return placed(find_files(spark, f"{root.rstrip('/')}/{INBOX_PATH}", "*.[cC][sS][vV]" if any_case else "*.csv"), root).withColumnRenamed("length", "size")


def placed(found: DataFrame, root: str) -> DataFrame:
    """Files below the inbox with bank, table, name and path below the root; files right in a bank's folder are none."""
    depth = INBOX_PATH.count("/") + 1
    parts = F.split("src_path", "/")
    return (
        found.withColumn("src_path", _below(F.col("path"), root))
        .filter(F.size(parts) >= depth + 3)
        .withColumn("bank", F.get(parts, F.lit(depth)))
        .withColumn("table_name", normalize_identifier(F.concat_ws("_", "bank", F.get(parts, F.lit(depth + 1)))))
        .withColumn("file_name", F.element_at(parts, -1))
    )


def settled(modified: Column, as_of: dt.datetime | None, seconds: int = SETTLE_SECONDS) -> Column:
    """Whether a file has rested: a predicate on the listing in place of waiting for each file."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of.isoformat()).cast("timestamp")
    return modified <= now - F.expr(f"INTERVAL {int(seconds)} SECONDS")


def with_digests(files: DataFrame) -> DataFrame:
    """Adds md5, header record, dialect and whether quoted fields hold line breaks, in one streamed read of each file.

    Needs `path`; `content` is dropped, so that Spark's reader only lists.
    """
    listed = files.drop("content")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in listed.schema.fields)
    return listed.mapInPandas(scan_batches, f"{fields}, md5 string, header string, separator string, quote string, escape string, quoted_breaks boolean")


def classify(files: DataFrame, ledger: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Adds `state`: known (same path and bytes in the ledger), unsettled, or new."""
    known = distinct_keys(ledger, ["src_path", "md5"]).withColumn("__known", F.lit(True))
    state = (
        F.when(F.col("__known"), F.lit("known"))
        .when(~settled(F.col("modificationTime"), as_of), F.lit("unsettled"))
        .otherwise(F.lit("new"))
    )
    return files.join(known, ["src_path", "md5"], "left").withColumn("state", state).drop("__known")


def ingest_summary(classified: DataFrame) -> DataFrame:
    return classified.agg(
        F.count_if(F.col("state") == "new").alias("ingested"), F.count_if(F.col("state") == "known").alias("skipped")
    )
