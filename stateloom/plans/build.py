"""Raw to view, incrementally, with checks between the layers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.functions.sql import register_sql_functions
from stateloom.operators.incremental import backfill_range, since_lookback
from stateloom.operators.keys import unseen_in_store
from stateloom.operators.mapping import INGESTED_AT, LOAD_KEY
from stateloom.plans import models
from stateloom.plans.bank import VIEW_SCHEMA, Bank
from stateloom.plans.warehouse import Warehouse
from stateloom.quality.gate import enforce, enforce_schema
from stateloom.quality.quarantine import split
from stateloom.sinks.tables import require_table


LAYERS = ("staging", "core", "mart")


def build(
    spark: SparkSession,
    warehouse: Warehouse,
    bank: Bank,
    run_ts: dt.datetime,
    run_id: str,
    full_refresh: bool = False,
    check_all: bool = False,
    skip_source_check: bool = False,
    set_aside: bool = False,
) -> dict[str, list[dict]]:
    """Bring staging, core and mart up to date; failed warnings per layer are returned.

    A failed error check stops the run before the next layer. Where the version a run started from
    has passed its checks, only the partitions the run has written are checked: in core and mart equal keys share a
    partition, and staging is searched for the keys that were added, so nothing else can have changed the outcome. `check_all` checks whole tables and
    reports their warnings; use it after changing the checks. An amount that does not convert stops the
    build; with `set_aside` its row goes to the quarantine table instead.
    """
    register_sql_functions(spark)
    ledger = warehouse.ledger_rows()
    raw_version = warehouse.raw(bank.raw_table).current(ledger)
    raw = warehouse.raw(bank.raw_table).read_or_none(ledger)
    if raw is None and skip_source_check:
        return {}
    raw = require_table(raw, bank.raw_table)
    warnings: dict[str, list[dict]] = {}

    staging, core, mart = warehouse.staging(bank.source), warehouse.core(bank.source), warehouse.mart(bank.source)

    stores = dict(zip(LAYERS, (staging, core, mart)))
    passed = {} if check_all or full_refresh else warehouse.passed_versions(bank.source)
    sound = {layer: layer in passed and passed[layer] == store.version() for layer, store in stores.items()}

    def checked(layer: str) -> None:
        rows = stores[layer].read_written(run_id) if sound[layer] else stores[layer].read()
        # staging is not partitioned by its key: the keys of what was added are looked up in the rest
        others = staging.read_others(run_id) if layer == "staging" and sound[layer] else None
        warnings[layer] = enforce(rows, bank.checks[layer], layer, others)

    stored = None if full_refresh else staging.read_or_none()
    if stored is not None:
        require_later(stored, run_ts)
    if set_aside:
        raw, broken = split(raw, [c for c in bank.amount_columns if c in raw.columns])
        aside = warehouse.set_aside(bank.source)
        known = aside.read_or_none()
        aside.append(broken if known is None else unseen_in_store(broken, known, LOAD_KEY), run_id, again=True)
    new_rows = models.staging(raw, bank, run_ts, stored)
    if stored is None:
        staging.overwrite(new_rows, run_id)
    else:
        staging.append(new_rows, run_id, again=True)  # what is stored is not in new_rows
    warehouse.note_staged(bank.raw_table, raw_version.version, run_id)
    checked("staging")

    for layer, store, upstream, model in (("core", core, staging, models.core), ("mart", mart, core, models.mart)):
        stored = None if full_refresh else store.read_or_none()
        source = upstream.read()
        if stored is None:
            store.overwrite(model(source, bank, run_ts), run_id)
        else:
            store.upsert(model(since_lookback(source, stored), bank, run_ts), "transaction_bk", run_id, again=True)
        checked(layer)

    view = combined(warehouse, bank)
    enforce_schema(view, VIEW_SCHEMA, "view")
    touched = models.combined_view(mart.read_written(run_id), bank) if sound["mart"] else view
    warnings["view"] = enforce(touched, bank.checks["view"], "view")
    versions = {layer: store.version() for layer, store in stores.items()}
    warehouse.note_passed(bank.source, versions, run_id)
    return warnings


def require_later(stored: DataFrame, run_ts: dt.datetime) -> None:
    """The next layers look back from the newest stamp: rows stamped before it would never reach them."""
    newest = stored.agg(F.max(INGESTED_AT)).first()[0]
    if newest is not None and run_ts < newest:
        raise ValueError(f"run time {run_ts} lies before the newest stored one, {newest}")


def backfill(
    spark: SparkSession, warehouse: Warehouse, bank: Bank, first: dt.date, last: dt.date, run_ts: dt.datetime, run_id: str
) -> dict[str, int]:
    """Derive core and mart again for the UTC days `first` to `last`, as one job per layer.

    Returns the rows replayed per layer. Only the months of those days are rewritten, and both layers
    pass their checks as in `build`.
    """
    register_sql_functions(spark)
    core, mart = warehouse.core(bank.source), warehouse.mart(bank.source)
    staged = backfill_range(warehouse.staging(bank.source).read(), "transacted_at_utc", first, last)
    replayed = {"core": core.upsert(models.core(staged, bank, run_ts), "transaction_bk", run_id, again=True)}
    enforce(core.read_written(run_id), bank.checks["core"], "core")
    cored = backfill_range(core.read(), "transacted_at_utc", first, last)
    replayed["mart"] = mart.upsert(models.mart(cored, bank, run_ts), "transaction_bk", run_id, again=True)
    enforce(mart.read_written(run_id), bank.checks["mart"], "mart")
    return replayed


def combined(warehouse: Warehouse, bank: Bank) -> DataFrame:
    """The combined view over the mart as it stands; later runs do not change what it reads."""
    return models.combined_view(warehouse.mart(bank.source).read(), bank)
