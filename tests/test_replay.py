"""Replays: outcomes per day and step, errors that stop no other day, kills at every commit."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stateloom.plans.bank import Bank
from stateloom.plans.replay import DONE, FAILED, HELD, OUTCOME_SCHEMA, replay, spans
from stateloom.plans.warehouse import Warehouse
from stateloom.sinks.tables import TableStore

from .conftest import RUN1, RUN2, tuples

STAGED = (
    "__load_key string, card_last4 string, status_nm string, category_nm string, description string, transaction_amt double, "
    "transaction_currency_cd string, transacted_at_utc timestamp_ntz, total_rewards_amt double, __ingested_at timestamp_ntz"
)


class Killed(BaseException):
    """Stands for the end of the process: nothing catches it."""


def staged_row(n, when, status="OK", amount=-1.5):
    return (f"k{n}", "*1", status, "c", f"row {n}", amount, "RUB", when, 0.0, RUN1)


def warehouse_of(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path / "house"))
    warehouse.staging("t_bank").overwrite(spark.createDataFrame(rows, STAGED), "r1")
    return warehouse


def test_spans():
    days = [dt.date(2025, 1, 30), dt.date(2025, 1, 31), dt.date(2025, 2, 1), dt.date(2025, 2, 3), dt.date(2024, 2, 3)]
    assert [(s[0], s[-1]) for s in spans(days)] == [(days[4], days[4]), (days[0], days[1]), (days[2], days[2]), (days[3], days[3])]
    assert list(spans([])) == []


def test_a_failing_day_stops_no_other_and_is_done_later(spark, tmp_path):
    rows = [staged_row(n, dt.datetime(2025, 3, n + 25, 12), amount=-1.0 - n) for n in range(3)]
    rows += [staged_row(9, dt.datetime(2025, 3, 26, 13), status="ODD"), staged_row(10, dt.datetime(2025, 4, 1), status="FAILED")]
    warehouse, bank = warehouse_of(spark, tmp_path, rows), Bank()
    first, last = dt.date(2025, 3, 24), dt.date(2025, 4, 1)
    told = {(r.day, r.step): r for r in replay(spark, warehouse, bank, first, last, RUN1, "spring").collect()}
    assert len(told) == 2 * 9
    bad = dt.date(2025, 3, 26)
    assert {k for k, r in told.items() if r.outcome != DONE} == {(bad, "core"), (bad, "mart")}
    assert told[bad, "core"].outcome == FAILED and "accepted_values(status_nm): 1" in told[bad, "core"].error
    assert told[bad, "mart"].outcome == HELD and told[bad, "mart"].n_rows is None
    assert (told[dt.date(2025, 3, 25), "core"].n_rows, told[first, "core"].n_rows, told[last, "core"].n_rows, told[last, "mart"].n_rows) == (1, 0, 1, 0)
    assert tuples(warehouse.mart("t_bank").read(), "description") == [("row 0",), ("row 2",)]

    # the source is mended; the same call does the rest and nothing twice
    fixed = [staged_row(9, dt.datetime(2025, 3, 26, 13)) if r[0] == "k9" else r for r in rows]
    warehouse.staging("t_bank").overwrite(spark.createDataFrame(fixed, STAGED), "r2")
    told = {(r.day, r.step): r for r in replay(spark, warehouse, bank, first, last, RUN2, "spring").collect()}
    assert {r.outcome for r in told.values()} == {DONE} and told[bad, "mart"].n_rows == 2
    assert {k for k, r in told.items() if r.attempt == 2} == {(bad, "core"), (bad, "mart")}
    stamped = warehouse.mart("t_bank").read().filter(F.col("__ingested_at") == RUN2)
    assert tuples(stamped, "description") == [("row 1",), ("row 9",)]
    version = warehouse.core("t_bank").version()
    replay(spark, warehouse, bank, first, last, RUN2, "spring")
    assert warehouse.core("t_bank").version() == version


@pytest.mark.parametrize("kill_at", [1, 2, 5])  # a layer's commit, its note, the first of the next layer
def test_killed_after_a_commit(spark, tmp_path, monkeypatch, kill_at):
    rows = [staged_row(n, dt.datetime(2025, 1 + n, 1, 12)) for n in range(2)]
    warehouse, bank = warehouse_of(spark, tmp_path, rows), Bank()
    first, last = dt.date(2025, 1, 31), dt.date(2025, 2, 1)
    real, commits, written = TableStore._commit, [], []

    def commit(self, current, run_id, schema, dirs):
        commits.append(run_id)
        real(self, current, run_id, schema, dirs)
        written.append((self.path, run_id))
        if len(commits) == kill_at:
            raise Killed

    monkeypatch.setattr(TableStore, "_commit", commit)
    with pytest.raises(Killed):
        replay(spark, warehouse, bank, first, last, RUN1, "x")
    told = replay(spark, warehouse, bank, first, last, RUN2, "x").collect()
    assert {(r.day, r.step, r.outcome, r.n_rows) for r in told} == {
        (day, step, DONE, int(day == last)) for day in (first, last) for step in ("core", "mart")
    }
    layers = [w for w in written if "meta" not in w[0]]
    assert len(layers) == len(set(layers)) == 4  # two months, two steps, each committed once
    notes = warehouse.replays("t_bank").read()
    assert notes.filter("outcome = 'done'").groupBy("day", "step").count().filter("count > 1").isEmpty()


def test_names_and_empty_tables(spark, tmp_path):
    warehouse, bank = warehouse_of(spark, tmp_path, []), Bank()
    day = dt.date(2025, 1, 1)
    with pytest.raises(ValueError):
        replay(spark, warehouse, bank, day, day, RUN1, "a.b")
    told = replay(spark, warehouse, bank, day, day, RUN1, "empty")
    assert {(r.step, r.outcome, r.n_rows) for r in told.collect()} == {("core", DONE, 0), ("mart", DONE, 0)}
    assert warehouse.replays("t_bank").read().schema.simpleString() == spark.createDataFrame([], OUTCOME_SCHEMA).schema.simpleString()
