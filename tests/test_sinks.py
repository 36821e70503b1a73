"""Table commits, bookmarks and the row sink."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest

from stateloom.plans.upkeep import drop_expired
from stateloom.sinks.bookmarks import bookmark_of, delta, export_delta, reset
from stateloom.sinks.rows import append_if_any
from stateloom.sinks.tables import TableStore

from .conftest import tuples

KV = "k string, v int, month string"


def test_store_commits_whole_directories(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"), "month")
    assert not store.exists() and store.read_or_none() is None
    with pytest.raises(FileNotFoundError):
        store.read()
    rows = lambda *values: spark.createDataFrame(list(values), KV)
    assert store.upsert(rows(("a", 1, "2024-01"), ("b", 1, "2024-01"), ("c", 1, "2024-02"), ("n", 1, None)), "k", "r1") == 4
    pinned = store.read()
    assert store.upsert(rows(("b", 2, "2024-01"), ("b", 3, "2024-01"), ("d", 2, "2024-03")), "k", "r2") == 3
    want = [("a", 1), ("b", 2), ("b", 3), ("c", 1), ("d", 2), ("n", 1)]
    assert tuples(store.read(), "k", "v") == want
    assert tuples(pinned, "k", "v") == [("a", 1), ("b", 1), ("c", 1), ("n", 1)]  # what was read stays
    assert store.upsert(rows(("z", 9, "2024-01")), "k", "r2") == 0  # r2 has committed
    assert tuples(store.read_written("r2"), "k", "v") == [("a", 1), ("b", 2), ("b", 3), ("d", 2)]
    assert store.append(rows(("e", 5, "2024-01")), "r3") == 1
    assert store.append(rows(), "r4") == 0
    assert store.read().count() == 7
    # an unfinished write is invisible
    rows(("y", 1, "2024-01")).write.parquet(f"{store.path}/data/r9/all")
    assert store.read().count() == 7
    assert store.overwrite(rows(), "r5") == 0
    assert store.read().count() == 0 and store.read().schema == pinned.schema
    (expired,) = store.expired_dirs(3)
    assert expired.startswith("data/r1/batch-") and expired.endswith("/__part=2024-01")
    assert drop_expired(store, 3) == [expired]
    assert drop_expired(store, 3) == []
    runs = spark.createDataFrame([("r3",), ("r1",)], "run_id string")
    assert store.read(runs).count() == 7


def test_bookmark_moves_after_the_send(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "marks"))
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    make = lambda *rows: spark.createDataFrame(list(rows), "id bigint, ts timestamp_ntz")
    first = make((1, at(1)), (2, at(2)), (3, at(2)))
    sent: list = []
    send = lambda frame: sent.append([r.id for r in frame.orderBy("id").collect()])

    def fail(_):
        raise OSError("sink is down")

    with pytest.raises(OSError):
        export_delta(first, store, "events", "ts", "id", "r1", fail)
    assert bookmark_of(store, "events") is None
    assert export_delta(first, store, "events", "ts", "id", "r1", send) == 3
    assert bookmark_of(store, "events") == (at(2), 3)
    more = first.unionByName(make((4, at(2)), (5, at(1)), (6, at(3))))
    assert tuples(delta(more, store, "events", "ts", "id"), "id") == [(4,), (6,)]
    assert export_delta(more, store, "events", "ts", "id", "r2", send) == 2
    assert export_delta(more, store, "events", "ts", "id", "r3", send) == 0
    assert sent == [[1, 2, 3], [4, 6]]
    assert export_delta(first, store, "other", "ts", "id", "r4", send) == 3
    reset(store, "r5", "dataset", "events")
    assert bookmark_of(store, "events") is None and bookmark_of(store, "other") == (at(2), 3)


def _file_consumer(folder: str):
    def connect():
        def append(batch_id, rows):
            Path(folder, f"{batch_id}.json").write_text(json.dumps(rows))

        return append

    return connect


def test_rows_reach_the_consumer_once_each(spark, tmp_path):
    df = spark.range(0, 25, 1, 3).selectExpr("cast(id as string) as a", "'x' as b")
    connect = _file_consumer(str(tmp_path))
    assert append_if_any(df, connect, "r1", ["A", "B"]) == 25
    batches = {p.stem: json.loads(p.read_text()) for p in tmp_path.glob("*.json")}
    assert batches.pop("r1-header") == [["A", "B"]]
    assert sorted(int(row[0]) for rows in batches.values() for row in rows) == list(range(25))
    assert sorted(batches) == ["r1-0-0", "r1-1-0", "r1-2-0"]
    empty = tmp_path / "empty"
    empty.mkdir()
    assert append_if_any(df.limit(0), _file_consumer(str(empty)), "r2", ["A"]) == 0
    assert not list(empty.iterdir())
