"""Each row reaches the consumer once, whatever is interrupted."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest

from stateloom.plans.run import run
from stateloom.sinks.outbox import Outbox

from .conftest import LATER, RUN1, RUN2, RUN3, RUN4, inbox, statement_row, write_statement

SCHEMA = "row_key string, stamp timestamp_ntz, cells array<string>"


def consumer(folder: Path, asks: bool = False, fails_at: str | None = None):
    """Writes a chunk under its id, and every call into a log of its own."""

    def connect():
        def append(chunk, rows):
            if fails_at and (Path(folder) / fails_at).exists() and not chunk.endswith("header"):
                raise OSError("the consumer is down")
            calls = len(list(Path(folder).glob(f"{chunk}.call*")))
            Path(folder, f"{chunk}.call{calls}").write_text(json.dumps(rows))

        if asks:
            append.known = lambda chunk: bool(list(Path(folder).glob(f"{chunk}.call*")))
        return append

    return connect


def received(folder: Path) -> list:
    """Rows of a consumer that remembers ids: a chunk counts once, and is the same each time."""
    chunks: dict = {}
    for path in folder.glob("*.call*"):
        rows = json.loads(path.read_text())
        assert chunks.setdefault(path.name.rpartition(".")[0], rows) == rows
    return sorted(tuple(row) for name, rows in chunks.items() if not name.endswith("header") for row in rows)


def calls(folder: Path) -> int:
    return len(list(folder.glob("*.call*")))


@pytest.fixture
def box(spark, tmp_path):
    folder = tmp_path / "consumer"
    folder.mkdir()

    def due(*rows):
        return spark.createDataFrame([(k, dt.datetime(2025, 1, 1, 0, 0, s), [k, str(v)]) for k, s, v in rows], SCHEMA).repartition(3)

    return Outbox(spark, str(tmp_path / "outbox"), "t", chunk_rows=2), folder, due


def test_new_and_changed_rows_only(box):
    outbox, folder, due = box
    assert outbox.deliver(consumer(folder), "r0", ["K", "V"]) == 0 and calls(folder) == 0
    first = [(f"k{i}", 1, i) for i in range(9)]
    assert outbox.stage(due(*first, first[0]), "r1") == 9
    assert outbox.deliver(consumer(folder), "r1", ["K", "V"]) == 9
    assert received(folder) == [(f"k{i}", str(i)) for i in range(9)]
    # the same rows under a later stamp, one changed, one new of the old stamp, one new
    again = [(k, 2, v) for k, _, v in first[1:]] + [("k0", 2, "x"), ("old", 1, "o"), ("new", 3, "n")]
    assert outbox.stage(due(*again), "r2") == 3
    assert outbox.deliver(consumer(folder), "r2", ["K", "V"]) == 3
    assert received(folder) == sorted([(f"k{i}", str(i)) for i in range(9)] + [("k0", "x"), ("old", "o"), ("new", "n")])
    assert outbox.stage(due(*again), "r3") == 0 and outbox.deliver(consumer(folder), "r3") == 0
    assert len(list(folder.glob("*header*"))) == 1


@pytest.mark.parametrize("asks", [True, False])
def test_consumer_fails_and_delivery_is_repeated(box, asks):
    outbox, folder, due = box
    outbox.stage(due(*[(f"k{i}", 1, i) for i in range(20)]), "r1")
    (folder / "down").touch()
    with pytest.raises(Exception, match="consumer is down"):
        outbox.deliver(consumer(folder, asks, "down"), "r1", ["K", "V"])
    assert received(folder) == [] and outbox.open_batches()
    (folder / "down").unlink()
    outbox.stage(due(("later", 2, 0)), "r2")
    assert outbox.deliver(consumer(folder, asks), "r2", ["K", "V"]) == 21
    assert len(received(folder)) == 21 and not outbox.open_batches()


@pytest.mark.parametrize("asks", [True, False])
def test_crash_between_send_and_acknowledgement(box, monkeypatch, asks):
    outbox, folder, due = box
    outbox.stage(due(*[(f"k{i}", 1, i) for i in range(7)]), "r1")
    with monkeypatch.context() as patched:
        patched.setattr(outbox.acks, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            outbox.deliver(consumer(folder, asks), "r1")
    before, sent = received(folder), calls(folder)
    assert len(before) == 7
    assert outbox.deliver(consumer(folder, asks), "r2") == 7
    assert received(folder) == before  # under the same ids, in the same chunks
    assert calls(folder) == (sent if asks else 2 * sent)
    assert outbox.deliver(consumer(folder, asks), "r3") == 0


@pytest.mark.parametrize("where", ["acks", "marks", "done", "rows"])
def test_crash_at_each_commit(box, monkeypatch, where):
    """Killed before any of the four commits, then run again: nothing is skipped, nothing comes under two ids."""
    outbox, folder, due = box
    rows = [(f"k{i}", 1, i) for i in range(5)]

    def work(run_id, *more):
        outbox.stage(due(*rows, *more), run_id)
        outbox.deliver(consumer(folder), run_id)

    with monkeypatch.context() as patched:
        patched.setattr(getattr(outbox, where), "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            work("r1")
    work("r2", ("later", 2, 0))
    assert received(folder) == sorted([(f"k{i}", str(i)) for i in range(5)] + [("later", "0")])
    work("r3")
    assert len(received(folder)) == 6


def test_second_run_sends_new_rows_only(spark, tmp_path):
    root, house, folder = tmp_path / "data", str(tmp_path / "house"), tmp_path / "sheet"
    folder.mkdir()
    first = [statement_row("14.09.2025 13:02:41", "-955,00", reward="9,00"), statement_row("14.09.2025 12:50:33", "-268,00")]
    write_statement(inbox(root) / "a.csv", first)
    assert run(spark, str(root), house, run_ts=RUN1, as_of=LATER, connect=consumer(folder))["appended"] == 3
    write_statement(inbox(root) / "b.csv", [statement_row("15.09.2025 09:00:00", "-7,00", description="new")])
    second = run(spark, str(root), house, run_ts=RUN2, as_of=LATER, connect=consumer(folder))
    assert second["appended"] == 1
    assert run(spark, str(root), house, run_ts=RUN3, as_of=LATER, connect=consumer(folder))["appended"] == 0
    # a rebuild stamps all rows anew and sends none
    assert run(spark, str(root), house, run_ts=RUN4, as_of=LATER, connect=consumer(folder), full_refresh=True)["appended"] == 0
    assert len(received(folder)) == 4 and [r for r in received(folder) if "new" in r]
