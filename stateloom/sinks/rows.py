"""Handing rows to an outside consumer, partition by partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row

from stateloom.session import checkpoint

# append(batch_id, rows): a batch id names the same rows in every attempt of a task, so a consumer
# that remembers ids can drop what a retried task sends again.
Append = Callable[[str, list[list[str]]], None]


def append_rows(df: DataFrame, connect: Callable[[], Append], run_id: str, batch_size: int = 500) -> None:
    """Send every row, as lists of cells in column order, from the executors.

    `connect` runs once per partition there and returns the consumer's append function.
    """

    def send(rows: Iterator[Row]) -> None:
        append, part = connect(), TaskContext.get().partitionId()
        for number, batch in enumerate(iter(lambda: list(islice(rows, batch_size)), [])):
            append(f"{run_id}-{part}-{number}", [list(row) for row in batch])

    df.foreachPartition(send)


def append_if_any(
    df: DataFrame, connect: Callable[[], Append], run_id: str, header: Sequence[str] | None = None
) -> int:
    """Send the rows and return their number; an empty frame sends nothing, not even the header.

    The frame is evaluated once, so that the number returned is the number sent.
    """
    df = checkpoint(df)
    count = df.count()
    if not count:
        return 0
    if header is not None:
        connect()(f"{run_id}-header", [list(header)])
    append_rows(df, connect, run_id)
    return count
