"""Wall-clock conversions over zone-free timestamps, independent of the session time zone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

STATEMENT_PATTERN = "d.M.yyyy H:m:s"
MOSCOW = "Europe/Moscow"
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z")


def local_to_utc(local: Column, zone: str = MOSCOW) -> Column:
    """Local wall time to UTC; in the hour a clock change repeats, the later instant."""
    hour = F.expr("INTERVAL 1 HOUR")

    def later_of_both(utc: Callable[[Column], Column]) -> Column:
        # an hour on is past the repeated hour, so stepping back lands on its second pass; everywhere
        # else the two agree, but for skipped times, where the first is the one to take
        return F.greatest(utc(local), utc(local + hour) - hour)

    def by_instant(t: Column) -> Column:
        return F.to_utc_timestamp(t.cast("timestamp_ltz"), zone).cast("timestamp_ntz")

    def by_names(t: Column) -> Column:
        return F.convert_timezone(F.lit(zone), F.lit("UTC"), t)

    # Going by instants looks the zone up once instead of per row, and is the same conversion as
    # long as the session's own zone is UTC. The session zone is a constant to the optimizer.
    in_utc = F.current_timezone().isin(*UTC_NAMES)
    return F.when(in_utc, later_of_both(by_instant)).otherwise(later_of_both(by_names))


def local_text_to_utc(text: Column, pattern: str = STATEMENT_PATTERN, zone: str = MOSCOW) -> Column:
    return local_to_utc(F.to_timestamp_ntz(text, F.lit(pattern)), zone)


def local_date(utc: Column, zone: str = MOSCOW, documented: bool = False) -> Column:
    """The calendar date of a stored UTC timestamp.

    By default the stored value is read as if it were wall time in `zone` and the date is taken in
    UTC, which is what the mart has always held. `documented=True` gives the date in `zone`, as
    the column's description says.
    """
    if documented:
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("date")
    return local_to_utc(utc, zone).cast("date")
