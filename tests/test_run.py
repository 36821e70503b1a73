"""Whole runs over statement files: counts, idempotence, upserts, publishing, upkeep."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stateloom.plans.bank import Bank
from stateloom.plans.build import backfill, build, combined
from stateloom.plans.ingest import ingest
from stateloom.plans.run import run
from stateloom.plans.upkeep import archive_files, prune_snapshots
from stateloom.plans.warehouse import Warehouse
from stateloom.quality.gate import ContractError, QualityError
from stateloom.sinks.snapshot import check_header, check_manifest, read_manifest

from .conftest import LATER, RUN1, RUN2, RUN3, RUN4, inbox, statement_row, tuples, write_statement

FIRST = [
    statement_row("14.09.2025 08:11:05", "-730,00", card="", category="Переводы", mcc=""),
    statement_row("14.09.2025 13:02:41", "-955,00", reward="9,00", cashback="9"),
    statement_row("14.09.2025 12:50:33", "-268,00", reward="4,00", cashback="4"),
    statement_row("14.09.2025 12:20:19", "-1475,00", reward="14,00", cashback="14", status="FAILED"),
]
VIEW_COLUMNS = [
    "bank_nm", "category_nm", "description", "transaction_amt", "transaction_currency_cd", "transaction_dt"
]


def test_run_end_to_end_and_again(spark, tmp_path):
    root, house = tmp_path / "data", str(tmp_path / "house")
    write_statement(inbox(root) / "2025" / "september.csv", FIRST)
    sent: list = []
    result = run(spark, str(root), house, run_ts=RUN1, as_of=LATER)
    assert (result["ingested"], result["skipped"], result["archived"]) == (1, 0, 1)

    warehouse = Warehouse(spark, house)
    staged = warehouse.staging("t_bank").read()
    assert staged.columns == ["__load_key", *sorted(c for c in staged.columns if not c.startswith("__")), "__ingested_at"]
    assert len(staged.columns) == 17
    assert warehouse.core("t_bank").read().count() == 4
    assert warehouse.mart("t_bank").read().count() == 3
    view = combined(warehouse, Bank())
    assert view.columns == VIEW_COLUMNS
    assert tuples(view, "category_nm", "transaction_amt", "transaction_dt") == sorted(
        [
            ("Cashback", 9.0, dt.date(2025, 9, 14)),
            ("Cashback", 4.0, dt.date(2025, 9, 14)),
            ("Маркетплейсы", -955.0, dt.date(2025, 9, 14)),
            ("Маркетплейсы", -268.0, dt.date(2025, 9, 14)),
            ("Переводы", -730.0, dt.date(2025, 9, 14)),
        ],
        key=repr,
    )

    manifest = result["manifest"]
    assert manifest["row_count"] == 5 and manifest["md5"] == manifest["results_md5"]
    assert manifest["date_folder"] == "20251001" and manifest["timestamp"] == "20251001_060000"
    check_manifest(spark, manifest)
    check_header(spark, manifest["csv_path"], VIEW_COLUMNS)
    with pytest.raises(ContractError):
        check_header(spark, manifest["csv_path"], VIEW_COLUMNS[::-1])
    with pytest.raises(ContractError):
        check_manifest(spark, {**manifest, "row_count": 6})
    stored = read_manifest(spark, str(root / "Archive/Bank/Exports/20251001" / "prod_imart_view_bank_transactions_manifest_20251001_060000.json"))
    assert stored == json.loads(json.dumps(manifest))

    assert not (inbox(root) / "2025" / "september.csv").exists()
    assert (root / "Archive" / "Bank" / "T-Bank" / "transactions" / "2025" / "september.csv").exists()
    ledger = warehouse.ledger_rows().collect()
    assert len(ledger) == 1 and ledger[0].archived_at == RUN1
    assert ledger[0].src_path == "To Parse/Bank/T-Bank/transactions/2025/september.csv"
    assert (ledger[0].bank, ledger[0].table_name, ledger[0].file_name) == ("T-Bank", "t_bank_transactions", "september.csv")

    # the same file dropped again is known; nothing changes
    write_statement(inbox(root) / "2025" / "september.csv", FIRST)
    again = run(spark, str(root), house, run_ts=RUN2, as_of=LATER)
    assert (again["ingested"], again["skipped"]) == (0, 1)
    assert warehouse.staging("t_bank").read().count() == 4
    assert tuples(combined(warehouse, Bank())) == tuples(view)
    assert again["manifest"]["md5"] == manifest["md5"]
    assert not sent


def test_later_batches_upsert_only_their_month(spark, tmp_path):
    root, house = tmp_path / "data", str(tmp_path / "house")
    write_statement(
        inbox(root) / "a.csv", [*FIRST, statement_row("05.03.2024 10:00:00", "-1,50", description="spring")]
    )
    warehouse, bank = Warehouse(spark, house), Bank()
    ingest(spark, warehouse, str(root), RUN1, "r1", LATER)
    build(spark, warehouse, bank, RUN1, "r1")

    # a known row is staged no second time, a new one is
    write_statement(inbox(root) / "b.csv", [FIRST[2], statement_row("15.09.2025 09:00:00", "-7,00")])
    assert ingest(spark, warehouse, str(root), RUN2, "r2", LATER) == {"ingested": 1, "skipped": 1}
    assert warehouse.raw("t_bank_transactions").read().count() == 2  # raw holds this run's files only
    build(spark, warehouse, bank, RUN2, "r2")
    assert warehouse.staging("t_bank").read().count() == 6
    spring = [d for part, d in warehouse.core("t_bank").current().dirs if part == "2024-03"]

    # a known business key with a new category, beyond the lookback of its first version
    changed = statement_row("14.09.2025 13:02:41", "-955,00", reward="9,00", cashback="9", category="Книги")
    # and one whose status has turned: the mart's batch holds successful rows only, so its old row stays
    turned = statement_row("14.09.2025 12:50:33", "-268,00", reward="4,00", cashback="4", status="FAILED")
    write_statement(inbox(root) / "c.csv", [changed, turned])
    ingest(spark, warehouse, str(root), RUN3, "r3", LATER)
    build(spark, warehouse, bank, RUN3, "r3")
    assert warehouse.staging("t_bank").read().count() == 8
    core = warehouse.core("t_bank").read()
    assert core.count() == 6
    assert [r.category_nm for r in core.filter("transaction_amt = -955").collect()] == ["Книги"]
    assert [d for part, d in warehouse.core("t_bank").current().dirs if part == "2024-03"] == spring
    assert core.filter("status_nm = 'OK'").count() == 4
    assert warehouse.mart("t_bank").read().count() == 5
    assert warehouse.passed_versions("t_bank") == {"staging": 3, "core": 3, "mart": 3}

    # replaying the spring day touches its month alone and changes nothing but the time of ingest
    autumn = [d for part, d in warehouse.core("t_bank").current().dirs if part != "2024-03"]
    day = dt.date(2024, 3, 5)
    assert backfill(spark, warehouse, bank, day, day, RUN4, "r4") == {"core": 1, "mart": 1}
    assert [d for part, d in warehouse.core("t_bank").current().dirs if part != "2024-03"] == autumn
    assert warehouse.core("t_bank").read().count() == 6
    assert [r.description for r in warehouse.mart("t_bank").read().filter(F.col("__ingested_at") == RUN4).collect()] == ["spring"]


def test_gate_stops_downstream(spark, tmp_path):
    root, house = tmp_path / "data", str(tmp_path / "house")
    # equal time, amount and card: one business key twice
    write_statement(inbox(root) / "a.csv", [FIRST[1], statement_row("14.09.2025 13:02:41", "-955,00", description="x")])
    warehouse, bank = Warehouse(spark, house), Bank()
    ingest(spark, warehouse, str(root), RUN1, "r1", LATER)
    with pytest.raises(QualityError, match=r"core: unique\(transaction_bk\): 1"):
        build(spark, warehouse, bank, RUN1, "r1")
    assert warehouse.mart("t_bank").read_or_none() is None
    assert warehouse.passed_versions("t_bank") == {}
    # a later run that leaves the broken month alone fails as well
    write_statement(inbox(root) / "b.csv", [statement_row("05.03.2024 10:00:00", "-1,50")])
    ingest(spark, warehouse, str(root), RUN3, "r2", LATER)
    with pytest.raises(QualityError, match=r"core: unique\(transaction_bk\): 1"):
        build(spark, warehouse, bank, RUN3, "r2")


def test_one_run_id_twice_loses_nothing(spark, tmp_path):
    root, house = tmp_path / "data", str(tmp_path / "house")
    warehouse, bank = Warehouse(spark, house), Bank()
    write_statement(inbox(root) / "a.csv", FIRST[:1])
    ingest(spark, warehouse, str(root), RUN1, "r1", LATER)
    write_statement(inbox(root) / "b.csv", FIRST[1:2])
    assert ingest(spark, warehouse, str(root), RUN1, "r1", LATER) == {"ingested": 1, "skipped": 1}
    assert warehouse.ledger_rows().count() == 2
    build(spark, warehouse, bank, RUN1, "r1")
    assert warehouse.staging("t_bank").read().count() == 2
    write_statement(inbox(root) / "c.csv", FIRST[2:3])
    ingest(spark, warehouse, str(root), RUN1, "r1", LATER)
    build(spark, warehouse, bank, RUN1, "r1")
    assert warehouse.staging("t_bank").read().count() == warehouse.core("t_bank").read().count() == 3
    build(spark, warehouse, bank, RUN1, "r1", full_refresh=True)
    assert archive_files(spark, warehouse, str(root), RUN1, "arch").count() == 3
    write_statement(inbox(root) / "d.csv", FIRST[3:])
    ingest(spark, warehouse, str(root), RUN1, "r1", LATER)
    archive_files(spark, warehouse, str(root), RUN1, "arch")
    ledger = warehouse.ledger_rows().collect()
    assert len(ledger) == 4 and all(r.archived_at == RUN1 for r in ledger)


def test_an_earlier_run_time_is_refused(spark, tmp_path):
    root, house = tmp_path / "data", str(tmp_path / "house")
    warehouse, bank = Warehouse(spark, house), Bank()
    write_statement(inbox(root) / "a.csv", FIRST[:1])
    ingest(spark, warehouse, str(root), RUN2, "r2", LATER)
    build(spark, warehouse, bank, RUN2, "r2")
    write_statement(inbox(root) / "b.csv", FIRST[1:2])
    ingest(spark, warehouse, str(root), RUN1, "r1", LATER)
    with pytest.raises(ValueError, match="lies before"):
        build(spark, warehouse, bank, RUN1, "r1")
    build(spark, warehouse, bank, RUN3, "r3")
    assert warehouse.core("t_bank").read().count() == 2


def test_rows_of_a_failed_build_are_not_lost(spark, tmp_path):
    root, house = tmp_path / "data", str(tmp_path / "house")
    warehouse, bank = Warehouse(spark, house), Bank()
    write_statement(inbox(root) / "a.csv", FIRST[:2])
    write_statement(inbox(root) / "bad.csv", [statement_row("15.09.2025 09:00:00", "0x1p3")])
    ingest(spark, warehouse, str(root), RUN1, "r1", LATER)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        build(spark, warehouse, bank, RUN1, "r1")
    write_statement(inbox(root) / "c.csv", FIRST[2:3])
    ingest(spark, warehouse, str(root), RUN2, "r2", LATER)
    assert warehouse.raw("t_bank_transactions").read().count() == 4
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        build(spark, warehouse, bank, RUN2, "r2")
    build(spark, warehouse, bank, RUN2, "r2", set_aside=True)
    assert warehouse.core("t_bank").read().count() == 3
    aside = warehouse.set_aside("t_bank").read().collect()
    assert len(aside) == 1 and aside[0].problems.startswith("Сумма операции,")


def test_build_needs_raw(spark, tmp_path):
    with pytest.raises(LookupError, match="t_bank_transactions"):
        build(spark, Warehouse(spark, str(tmp_path / "none")), Bank(), RUN1, "r1")


def test_full_refresh_rebuilds_and_warnings_do_not_stop(spark, tmp_path):
    root, house = tmp_path / "data", str(tmp_path / "house")
    dollars = statement_row("14.09.2025 13:02:41", "-5,00")
    dollars[5] = "USD"
    write_statement(inbox(root) / "a.csv", [*FIRST, dollars])
    warehouse = Warehouse(spark, house)
    ingest(spark, warehouse, str(root), RUN1, "r1", LATER)
    warnings = build(spark, warehouse, Bank(), RUN1, "r1")
    assert [w["column_name"] for w in warnings["view"]] == ["transaction_currency_cd"]
    write_statement(inbox(root) / "b.csv", FIRST[:1])
    ingest(spark, warehouse, str(root), RUN2, "r2", LATER)
    build(spark, warehouse, Bank(), RUN2, "r2", full_refresh=True)
    assert warehouse.staging("t_bank").read().count() == 1
    assert warehouse.mart("t_bank").read().count() == 1


def test_prune_keeps_ten_newest_dated_folders(spark, tmp_path):
    import os

    exports = tmp_path / "Exports"
    for day in range(1, 13):
        folder = exports / f"202509{day:02d}" / "t.csv"
        folder.mkdir(parents=True)
        part = folder / "part-0.csv"
        part.write_text("a\n1\n")
        os.utime(part, (1_700_000_000 + day * 60,) * 2)
    for other in ("notes", "20251399"):
        (exports / other).mkdir()
        (exports / other / "part-0.csv").write_text("a\n")
    assert prune_snapshots(spark, str(exports)) == {"deleted_count": 2, "kept_count": 10}
    assert sorted(p.name for p in exports.iterdir()) == sorted([f"202509{d:02d}" for d in range(3, 13)] + ["notes", "20251399"])
