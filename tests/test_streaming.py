"""Files as a stream: incremental append, dedupe with and without a watermark, archiving."""

from __future__ import annotations

import os

from stateloom.sinks.tables import TableStore
from stateloom.streaming.ingest import (
    append_unseen, distinct_by_key, distinct_within_lookback, statement_stream, to_files,
)
from pyspark.sql import functions as F

from .conftest import RUN1, write_text

COLUMNS = ["id", "name"]


def test_append_unseen_across_runs_and_replay(spark, tmp_path):
    inbox = tmp_path / "in"
    write_text(inbox / "a.csv", "id,name\n1,x\n2,y\n")
    store = TableStore(spark, str(tmp_path / "raw"))

    def once(checkpoint: str):
        stream = statement_stream(spark, str(inbox), COLUMNS, ",")
        append_unseen(stream, store, "raw", str(tmp_path / checkpoint), RUN1).awaitTermination()

    once("cp")
    assert store.read().count() == 2
    write_text(inbox / "b.csv", "id,name\n2,y\n3,z\n")
    once("cp")
    assert sorted(r.id for r in store.read().collect()) == ["1", "2", "3"]
    once("cp")
    assert store.read().count() == 3
    # a lost checkpoint begins again with batch 0: old rows are not added twice, a new file's are not lost
    write_text(inbox / "c.csv", "id,name\n4,q\n")
    once("fresh")
    assert sorted(r.id for r in store.read().collect()) == ["1", "2", "3", "4"]


def test_distinct_by_key_keeps_state_between_runs(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    write_text(inbox / "a.csv", "id,name\n1,x\n1,x\n2,y\n")
    for extra in (None, "id,name\n2,y\n3,z\n"):
        if extra:
            write_text(inbox / "b.csv", extra)
        stream = distinct_by_key(statement_stream(spark, str(inbox), COLUMNS, ","))
        to_files(stream, out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_distinct_within_lookback_forgets_old_keys(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    days = {"a": ["1,2024-01-01", "1,2024-01-01"], "b": ["2,2024-01-05"], "c": ["1,2024-01-06", "2,2024-01-05"]}
    for name, rows in days.items():
        write_text(inbox / f"{name}.csv", "id,name\n" + "\n".join(rows) + "\n")
        stream = statement_stream(spark, str(inbox), COLUMNS, ",").select(
            F.col("id"), F.col("name").cast("timestamp_ltz").alias("at")
        )
        to_files(distinct_within_lookback(stream, "at", "id"), out, str(tmp_path / "cp")).awaitTermination()
    seen = sorted((r.id, str(r.at)[:10]) for r in spark.read.parquet(out).collect())
    # key 1 came back after its state had expired, key 2 within its day
    assert seen == [("1", "2024-01-01"), ("1", "2024-01-06"), ("2", "2024-01-05")]


def test_files_move_to_the_archive_after_a_later_batch(spark, tmp_path):
    inbox, archive = tmp_path / "in", tmp_path / "archive"
    for number in range(3):
        path = write_text(inbox / f"{number}.csv", f"id,name\n{number},x\n")
        os.utime(path, (1_700_000_000 + number,) * 2)
    stream = statement_stream(spark, str(inbox), COLUMNS, ",", archive=str(archive), max_files=1)
    to_files(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    moved = sorted(p.name for p in archive.rglob("*.csv"))
    assert "0.csv" in moved and not (inbox / "0.csv").exists()
