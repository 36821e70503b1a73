"""Files as a stream: changed ones are read again, and nothing is loaded twice."""

from __future__ import annotations

import os

import pytest

from stateloom.plans import ingest as plans
from stateloom.plans.warehouse import Warehouse
from stateloom.streaming import changes
from stateloom.streaming.changes import ChangeReader, ingest_changes

from .conftest import RUN1, RUN2, inbox, tuples, write_text


def load(spark, warehouse, root, checkpoint, run_ts=RUN1, **more):
    query = ingest_changes(spark, warehouse, str(root), str(checkpoint), run_ts, settle_seconds=0, **more)
    query.awaitTermination(120)
    assert query.exception() is None
    return warehouse.ledger_rows().count()


def rows(warehouse):
    return tuples(warehouse.raw("any_rows").read(), "id", "name")


def test_a_changed_file_is_read_again_in_a_second_run(spark, tmp_path):
    root, folder, log = tmp_path / "My Data", inbox(tmp_path / "My Data", "Any", "rows"), tmp_path / "log"
    warehouse = Warehouse(spark, str(tmp_path / "house"))
    a = write_text(folder / "a.csv", "id,name\n1,x\n")
    write_text(folder / "deep" / "b.csv", "id;name\n2;y\n")
    write_text(folder / "empty.csv", "")
    write_text(folder / "notes.txt", "id\n9\n")
    write_text(root / "To Parse" / "Bank" / "Any" / "no_type.csv", "id\n9\n")
    assert load(spark, warehouse, root, log) == 2
    assert rows(warehouse) == [("1", "x"), ("2", "y")]
    # nothing new; then other bytes of the same length, a touched file and a new one
    assert load(spark, warehouse, root, log, RUN2) == 2
    write_text(a, "id,name\n3,z\n")
    os.utime(a, (1_700_000_000,) * 2)
    os.utime(folder / "deep" / "b.csv", (1_700_000_001,) * 2)
    write_text(folder / "c.csv", "id,name\n4,w\n")
    assert load(spark, warehouse, root, log, RUN2) == 4
    assert rows(warehouse) == [("1", "x"), ("2", "y"), ("3", "z"), ("4", "w")]
    ledger = warehouse.ledger_rows()
    assert ledger.filter("file_name = 'a.csv'").select("md5").distinct().count() == 2
    assert ledger.filter("file_name = 'b.csv'").count() == 1


def test_a_failed_batch_is_repeated_with_its_files(spark, tmp_path, monkeypatch):
    folder, log = inbox(tmp_path, "Any", "rows"), tmp_path / "log"
    warehouse = Warehouse(spark, str(tmp_path / "house"))
    for k in range(3):
        write_text(folder / f"{k}.csv", f"id,name\n{k},x\n")
    write_text(inbox(tmp_path, "Other", "rows") / "o.csv", "id\n7\n")
    real, calls = plans.read_statements, []

    def fails(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost on the way")
        return real(*args, **kwargs)

    monkeypatch.setattr(plans, "read_statements", fails)
    query = ingest_changes(spark, warehouse, str(tmp_path), str(log), RUN1, settle_seconds=0)
    with pytest.raises(Exception, match="lost on the way"):
        query.awaitTermination(120)
    assert warehouse.ledger_rows().count() == 3  # the first table was loaded
    monkeypatch.undo()
    write_text(folder / "3.csv", "id,name\n3,x\n")
    assert load(spark, warehouse, tmp_path, log, RUN2) == 4  # the batch as it was planned
    assert load(spark, warehouse, tmp_path, log, RUN2) == 5
    assert rows(warehouse) == [(str(k), "x") for k in range(4)]
    assert warehouse.raw("other_rows").read().count() == 1


def test_offsets_files_and_limits(tmp_path):
    folder = tmp_path / "in"
    for k in range(5):
        write_text(folder / f"{k}.csv", f"id\n{k}\n")
    reader = lambda **o: ChangeReader({"path": f"file:{folder}", "log": f"file:{tmp_path}/log", "settleseconds": 0, **o})
    assert reader().initialOffset() == {"batch": 0}
    assert ChangeReader({"path": f"file:{folder}", "log": f"file:{tmp_path}/log", "settleseconds": 3600}).latestOffset() == {"batch": 0}
    assert [reader(maxfiles=2).latestOffset()["batch"] for _ in range(5)] == [1, 2, 3, 3, 3]
    again = reader()
    (part,) = again.partitions({"batch": 1}, {"batch": 3})
    assert [f[0].rpartition("/")[2] for f in part.files] == ["2.csv", "3.csv", "4.csv"]
    (folder / "3.csv").unlink()  # archived or gone since
    assert [r[0].rpartition("/")[2] for r in again.read(part)] == ["2.csv", "4.csv"]
    assert again.partitions({"batch": 3}, {"batch": 3}) == []
    # a plan that was cut off while it was written counts for nothing
    write_text(tmp_path / "log" / "4.json.part", "[[")
    assert reader().latestOffset() == {"batch": 3}
    assert changes.file_system("file:/a b/c")[1:] == ("/a b/c", "file:")
