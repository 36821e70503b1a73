"""Late and repeated rows by key and content: what changes a key passes, what repeats it does not.

State per key is the newest version's time and md5, and the md5s seen at that very time. A timer drops it once the
watermark has passed that time by the lookback, so state follows the keys of the lookback, not those of all time.
The session's state store has to be RocksDB's (`build_session` sets it where the launcher has not).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stateloom.functions.keys import load_key
from stateloom.operators.incremental import LOOKBACK


class Versions(StatefulProcessor):
    """Of one key's rows those that replace its newest version; memory holds the versions of one instant."""

    def __init__(self, columns: Sequence[str], late_ms: int):
        self.columns, self.late_ms = list(columns), late_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "at long, content string")
        self.seen = handle.getMapState("seen", "content string", "at long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        known_at, known = self.newest.get() or (None, None)
        at, versions = known_at, {}
        for row in rows:
            *_, when, content = row
            if at is not None and when < at:
                continue  # a newer version is known
            if at is None or when > at:
                at, versions = when, {}
            versions.setdefault(content, row)
        if at == known_at:
            fresh = [c for c in sorted(versions) if not self.seen.containsKey((c,))]
        else:
            fresh = [c for c in sorted(versions) if c != known]
            self.seen.clear()
            if known_at is not None:
                self.handle.deleteTimer(self.expiry(known_at))
            self.handle.registerTimer(self.expiry(at))
            for content in versions:
                self.seen.updateValue((content,), (at,))
        for content in fresh:
            self.seen.updateValue((content,), (at,))
            yield Row(*self.columns)(*versions[content][: len(self.columns)])
        if fresh or at != known_at:
            self.newest.update((at, fresh[-1] if fresh else known))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.newest.clear()
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass

    def expiry(self, at: int) -> int:
        """In milliseconds, rounded up, so that state never goes early."""
        return -(-at // 1000) + self.late_ms


def changed_within_lookback(
    stream: DataFrame, time: str, key: str, columns: Sequence[str] | None = None, late: str = LOOKBACK
) -> DataFrame:
    """The rows that change what is known of their key, in the columns of `stream`.

    Content is the md5 of `columns`, by default all but `time`. A row passes if nothing newer is known of its key and

    * it is newer than what is known and has another content, also one that the key had before, or
    * it is as old as that, with a content not seen at that time: a correction. Read again, none of them passes.

    Of one batch only a key's newest rows count. Rows older than the watermark (`late` behind the newest time of the
    stream) are dropped, rows without a time too; a null key is a key. A key that comes back after its state has expired is new.
    `time` must be a plain TIMESTAMP: watermarks do not take zone-free ones.
    """
    bound = late.removeprefix("INTERVAL ").lower()
    late_ms = stream.sparkSession.sql(f"SELECT unix_millis(timestamp_seconds(0) + INTERVAL {bound})").first()[0]
    content = load_key(stream, columns or [c for c in stream.columns if c != time])
    rows = stream.withWatermark(time, bound).filter(F.col(time).isNotNull())
    helpers = [F.unix_micros(F.col(time)).alias("__version_at"), content.alias("__version_content")]
    versions = rows.select("*", *helpers).groupBy(key)
    return versions.transformWithState(Versions(stream.columns, late_ms), stream.schema, "Append", "EventTime")
