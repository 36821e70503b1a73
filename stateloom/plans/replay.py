"""Replaying a range of days with an outcome for every day and step, which a repeated call goes on from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.functions.sql import register_sql_functions
from stateloom.operators.incremental import backfill_range
from stateloom.plans import models
from stateloom.plans.bank import Bank
from stateloom.plans.warehouse import Warehouse
from stateloom.quality.gate import enforce
from stateloom.sinks.tables import TableStore

OUTCOME_SCHEMA = "replay_id string, attempt int, day date, step string, outcome string, n_rows bigint, error string"
STEPS = ("core", "mart")
DONE, FAILED, HELD = "done", "failed", "held back"
ERROR_LENGTH = 500
UTC_TIME = "transacted_at_utc"


def spans(days: Iterable[dt.date]) -> Iterator[list[dt.date]]:
    """Days in order, as runs of neighbours within one month: a month is what an upsert rewrites."""
    run: list[dt.date] = []
    for day in sorted(days):
        if run and (day - run[-1] != dt.timedelta(days=1) or day.month != run[-1].month):
            yield run
            run = []
        run.append(day)
    if run:
        yield run


def unit_name(replay_id: str, step: str, days: list[dt.date]) -> str:
    return f"{replay_id}.{step}.{days[0]}.{days[-1]}"


def days_between(first: dt.date, last: dt.date) -> list[dt.date]:
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]


def committed_days(store: TableStore, replay_id: str, step: str) -> set[dt.date]:
    """The days whose rows this replay has committed, told by the names of the commits."""
    mark = f"{replay_id}.{step}."
    named = store.commits().filter(F.col("run_id").startswith(mark)).select("run_id").distinct().collect()
    ends = [r.run_id[len(mark) :].split(".") for r in named]
    return {day for first, last in ends for day in days_between(dt.date.fromisoformat(first), dt.date.fromisoformat(last))}


def replay(
    spark: SparkSession, warehouse: Warehouse, bank: Bank, first: dt.date, last: dt.date, run_ts: dt.datetime, replay_id: str
) -> DataFrame:
    """Derive core and mart again for the UTC days `first` to `last`; the outcome of every day and step.

    The days of a month go together. If they fail, they are halved, and so on, so that a day with an error
    stops no other; its next step is held back. A day's rows pass their checks before anything is committed.
    A call with the same `replay_id` does what is not done yet: what a commit bears is never written again,
    even where the call before was killed before it could note the outcome. Outcomes are as in `outcomes`.
    """
    if "." in replay_id or "/" in replay_id:
        raise ValueError(f"{replay_id!r} cannot name a replay: no dots and slashes")
    register_sql_functions(spark)
    log = warehouse.replays(bank.source)
    noted = log.read_or_none()
    notes = [] if noted is None else noted.filter(F.col("replay_id") == replay_id).select("attempt", "day", "step", "outcome").collect()
    attempt = 1 + max((n.attempt for n in notes), default=0)
    stores = {"core": warehouse.core(bank.source), "mart": warehouse.mart(bank.source)}
    sources = {"core": warehouse.staging(bank.source), "mart": stores["core"]}
    derive = {"core": models.core, "mart": models.mart}

    def note(step: str, days: list[dt.date], outcome: str, error: str | None = None) -> None:
        counts = rows_by_day(stores[step], days) if outcome == DONE else {}
        rows = [(replay_id, attempt, d, step, outcome, counts.get(d, 0) if outcome == DONE else None, error) for d in days]
        log.append(spark.createDataFrame(rows, OUTCOME_SCHEMA).coalesce(1), f"{replay_id}-{attempt}-{step}-{days[0]}", again=True)

    def attempted(step: str, days: list[dt.date]) -> str | None:
        """Writes and notes the days; what went wrong, or None."""
        try:
            rows = backfill_range(sources[step].read(), UTC_TIME, days[0], days[-1])
            batch = derive[step](rows, bank, run_ts)
            enforce(batch, bank.checks[step], step)
            stores[step].upsert(batch, "transaction_bk", unit_name(replay_id, step, days))
        except Exception as error:
            return str(error)[:ERROR_LENGTH]
        note(step, days, DONE)
        return None

    def settle(step: str, days: list[dt.date]) -> set[dt.date]:
        """Days that fail together are halved until the days with an error stand alone; the days that went well."""
        error = attempted(step, days)
        if error is None:
            return set(days)
        if len(days) == 1:
            note(step, days, FAILED, error)
            return set()
        middle = len(days) // 2
        return settle(step, days[:middle]) | settle(step, days[middle:])

    wanted = set(days_between(first, last))
    ready = set(wanted)
    for step in STEPS:
        for run in spans(wanted - ready):
            note(step, run, HELD)
        done = committed_days(stores[step], replay_id, step) & wanted
        told = {n.day for n in notes if n.step == step and n.outcome == DONE}
        for run in spans(done - told):
            note(step, run, DONE)
        for run in spans(ready - done):
            done |= settle(step, run)
        ready &= done
    return outcomes(log.read(), replay_id).filter(F.col("day").between(F.lit(first), F.lit(last)))


def rows_by_day(store: TableStore, days: list[dt.date]) -> dict[dt.date, int]:
    """How many rows the table holds of each of these neighbouring days."""
    rows = backfill_range(store.read(), UTC_TIME, days[0], days[-1])
    return {r.day: r["count"] for r in rows.groupBy(F.to_date(UTC_TIME).alias("day")).count().collect()}


def outcomes(log: DataFrame, replay_id: str) -> DataFrame:
    """The last noted outcome per day and step: day, step, outcome, n_rows (of the day in the table), error, attempt."""
    newest = F.max_by(F.struct("outcome", "n_rows", "error", "attempt"), "attempt").alias("last")
    return log.filter(F.col("replay_id") == replay_id).groupBy("day", "step").agg(newest).select("day", "step", "last.*")
