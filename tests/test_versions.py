"""Changed rows pass and repeats do not, across restarts of the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from stateloom.streaming.ingest import statement_stream, to_files
from stateloom.streaming.versions import changed_within_lookback

from .conftest import write_text

COLUMNS = ["id", "status", "at"]


class Feed:
    """A folder of files and a stream over it that is started anew for every file."""

    def __init__(self, spark, tmp_path):
        self.spark, self.tmp, self.files, self.known = spark, tmp_path, 0, []

    def send(self, *rows: str) -> list[tuple]:
        """What one more run lets through of one more file."""
        write_text(self.tmp / "in" / f"{self.files}.csv", "id,status,at\n" + "\n".join(rows) + "\n")
        self.files += 1
        stream = statement_stream(self.spark, str(self.tmp / "in"), COLUMNS, ",").select(
            "id", "status", F.col("at").cast("timestamp_ltz").alias("at")
        )
        to_files(changed_within_lookback(stream, "at", "id"), str(self.tmp / "out"), str(self.tmp / "cp")).awaitTermination()
        out = self.spark.read.parquet(str(self.tmp / "out")).select("id", "status", F.date_format("at", "MM-dd HH:mm:ss.SSSSSS").alias("at"))
        now = sorted((tuple(r) for r in out.collect()), key=str)
        fresh = list(now)
        for r in self.known:
            fresh.remove(r)
        self.known = now
        return [r[:2] for r in fresh]


def test_changed_rows_pass_and_repeats_do_not(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    first = ["1,open,2024-01-01 10:00:00.000001", "2,open,2024-01-01 10:00:00", "2,open,2024-01-01 10:00:00"]
    assert feed.send(*first) == [("1", "open"), ("2", "open")]
    assert feed.known[0] == ("1", "open", "01-01 10:00:00.000001")
    assert feed.send(*first) == []  # the same rows in another file
    assert feed.send("1,done,2024-01-01 11:00:00", "2,open,2024-01-01 11:00:00") == [("1", "done")]
    assert feed.send("1,open,2024-01-01 10:30:00") == []  # late, and a newer version is known
    assert feed.send("1,open,2024-01-01 12:00:00") == [("1", "open")]  # back to what it was
    assert feed.send("3,late,2024-01-01 02:00:00") == [("3", "late")]  # late, within the lookback, nothing newer


def test_corrections_at_the_same_time(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert feed.send("1,a,2024-01-01 10:00:00") == [("1", "a")]
    assert feed.send("1,b,2024-01-01 10:00:00") == [("1", "b")]
    assert feed.send("1,a,2024-01-01 10:00:00", "1,b,2024-01-01 10:00:00") == []
    # several versions in one batch: only the newest counts, whatever their order
    assert feed.send("1,d,2024-01-01 13:00:00", "1,c,2024-01-01 12:00:00", "2,y,2024-01-01 12:00:00", "2,z,2024-01-01 13:00:00") == [("1", "d"), ("2", "z")]


def test_state_expires_and_late_rows_are_dropped(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert feed.send("1,a,2024-01-01 10:00:00", ",a,2024-01-01 10:00:00", "7,x,") == [("1", "a"), (None, "a")]
    assert feed.send("2,a,2024-01-05 10:00:00") == [("2", "a")]
    assert feed.send("3,a,2024-01-03 10:00:00") == []  # two days behind the newest time
    # key 1 came back after its state had expired, key 2 within its day
    assert feed.send("1,a,2024-01-05 11:00:00", "2,a,2024-01-05 11:00:00") == [("1", "a")]
