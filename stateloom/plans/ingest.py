"""New statement files into raw tables, each file once."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.operators.mapping import INGESTED_AT, run_stamp
from stateloom.plans.warehouse import Warehouse
from stateloom.session import checkpoint
from stateloom.sources.files import classify, ingest_summary, statement_files, with_digests
from stateloom.sources.statements import new_files, read_statements


def ledger_entries(files: DataFrame, run_ts: dt.datetime, run_id: str) -> DataFrame:
    return files.select(
        "bank",
        "table_name",
        "file_name",
        "src_path",
        "size",
        "md5",
        run_stamp(run_ts).alias("ingested_at"),
        F.lit(None).cast("timestamp_ntz").alias("archived_at"),
        F.lit(run_id).alias("run_id"),
    )


def ingest(
    spark: SparkSession,
    warehouse: Warehouse,
    root: str,
    run_ts: dt.datetime,
    run_id: str,
    as_of: dt.datetime | None = None,
    any_case: bool = False,
    mode: str = "FAILFAST",
) -> dict[str, int]:
    """Counts of ingested and skipped files.

    A table with new files comes to hold their rows: instead of what it held, if that has been
    staged, else besides it. Then its files enter the ledger: the ledger entry is the commit. A table
    without new files keeps its rows, and so does one whose new files fail to load. Every call is an
    attempt of its own, so that a run id may be used again.
    """
    found = with_digests(statement_files(spark, root, any_case))
    return ingest_files(spark, warehouse, found, run_ts, run_id, as_of, mode)


def ingest_files(
    spark: SparkSession, warehouse: Warehouse, found: DataFrame, run_ts: dt.datetime, run_id: str, as_of: dt.datetime | None = None,
    mode: str = "FAILFAST",
) -> dict[str, int]:
    """`ingest` for files that were found, placed and read for their digests by other means."""
    # Hashing reads every byte of the inbox, so its outcome is kept rather than recomputed below.
    classified = checkpoint(classify(found, warehouse.ledger_rows(), as_of))
    counts = ingest_summary(classified).first()
    fresh = classified.filter(F.col("state") == "new")
    tables = [r[0] for r in fresh.select("table_name").distinct().orderBy("table_name").collect()]
    for table_name in tables:
        rows = read_statements(spark, new_files(classified, table_name), mode=mode)
        stamped = rows.withColumn(INGESTED_AT, run_stamp(run_ts))
        table_run = f"{run_id}-{table_name}-{uuid.uuid4().hex[:12]}"
        if warehouse.is_staged(table_name):
            warehouse.raw(table_name).overwrite(stamped, table_run)
        else:
            warehouse.raw(table_name).append(stamped, table_run, warehouse.ledger_rows())
        entries = ledger_entries(fresh.filter(F.col("table_name") == table_name), run_ts, table_run)
        warehouse.ledger().append(entries, table_run)
    return {"ingested": counts["ingested"], "skipped": counts["skipped"]}
