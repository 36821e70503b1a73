"""One run from files to published snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stateloom.operators.layout import display_cells, header
from stateloom.operators.mapping import INGESTED_AT
from stateloom.plans import models
from stateloom.plans.bank import Bank
from stateloom.plans.build import build, combined
from stateloom.plans.ingest import ingest
from stateloom.plans.upkeep import archive_files, drop_expired, drop_old_copies, prune_snapshots
from stateloom.plans.warehouse import Warehouse
from stateloom.sinks.latest import LatestCopy
from stateloom.sinks.rows import Append
from stateloom.sinks.snapshot import publish_snapshot

# Fixed value: the name the published view goes by.
VIEW_NAME = "prod_imart.view_bank_transactions"
# so many newest versions of a table keep their directories: a reader of the last run's tables stays safe
KEEP_VERSIONS = 3


def append_new(warehouse: Warehouse, bank: Bank, connect: Callable[[], Append], run_id: str) -> int:
    """Rows of the combined view that the consumer has not been sent as they are now; their number."""
    outbox = warehouse.outbox(bank.source)
    rows = models.keyed_view(warehouse.mart(bank.source).read(), bank)
    outbox.stage(rows.select("row_key", F.col(INGESTED_AT).alias("stamp"), display_cells(rows).alias("cells")), run_id)
    return outbox.deliver(connect, run_id, header())


def run(
    spark: SparkSession,
    root: str,
    warehouse_path: str,
    bank: Bank | None = None,
    run_ts: dt.datetime | None = None,
    connect: Callable[[], Append] | None = None,
    full_refresh: bool = False,
    as_of: dt.datetime | None = None,
) -> dict:
    """Ingest, build, publish, append what is new to the display consumer if there is one, archive, prune.

    The consumer gets each row once, over all runs: rows go through an outbox, which a later run finishes
    where this one is interrupted.
    """
    bank = bank or Bank()
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run_id = run_ts.strftime("%Y%m%dT%H%M%S%f")
    root = root.rstrip("/")
    warehouse = Warehouse(spark, warehouse_path)
    counts = ingest(spark, warehouse, root, run_ts, run_id, as_of)
    warnings = build(spark, warehouse, bank, run_ts, run_id, full_refresh)
    view = combined(warehouse, bank)
    exports = f"{root}/Archive/Bank/Exports"
    manifest = publish_snapshot(view, VIEW_NAME, exports, f"{root}/Results", run_ts, materialize=False)
    appended = append_new(warehouse, bank, connect, run_id) if connect else 0
    moved = archive_files(spark, warehouse, root, run_ts, f"{run_id}-archive")
    archived = moved.filter(F.col("outcome") == "archived").count()
    pruned = prune_snapshots(spark, exports)
    stores = (warehouse.raw(bank.raw_table), warehouse.core(bank.source), warehouse.mart(bank.source), warehouse.ledger())
    pruned["old_copies"] = len(drop_old_copies(LatestCopy(spark, f"{root}/Results/bank_transactions.csv")))
    expired = sum(len(drop_expired(store, KEEP_VERSIONS)) for store in stores)
    return {
        **counts, "warnings": warnings, "manifest": manifest, "appended": appended, "archived": archived, "expired": expired,
        **pruned,
    }
