"""A profile merged from directories equals a profile of the whole table."""

from __future__ import annotations

import datetime as dt
import random
import shutil
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stateloom.quality.running import RunningProfile
from stateloom.sinks.tables import TableStore

SCHEMA = "k string, v double, n bigint, d decimal(18,2), day date, note string, month string"


def make(spark, ids, seed):
    rng = random.Random(seed)
    rows = []
    for i in ids:
        day = dt.date(2025, 1 + i % 4, 1 + i % 27)
        v = None if rng.random() < 0.1 else 1e6 + rng.gauss(0, 3)  # far from 0: squares must not cancel
        rows.append((f"k{i}", v, rng.choice([None, i, 1 << 60]), Decimal(i).scaleb(-2), day, rng.choice(["a", "b", "", None, f"x{i}"]), str(day)[:7]))
    return spark.createDataFrame(rows, SCHEMA)


def assert_same(profile, rows):
    got = profile.first().asDict()
    want = rows.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("k").alias("unique_k"),
        *[f(c).alias(f"{name}_{c}") for c in ("v", "n", "d", "day", "note", "k") for name, f in (("min", F.min), ("max", F.max))],
        *[F.count(c).alias(f"{c}_complete") for c in ("v", "n", "d", "day", "note", "k")],
    ).first().asDict()
    assert {k: got[k] for k in want} == want
    close = rows.agg(*[e for c in ("v", "n", "d") for e in (F.avg(F.col(c).cast("double")).alias(f"avg_{c}"), F.stddev_samp(F.col(c).cast("double")).alias(f"{c}_stddev"))])
    for name, value in close.first().asDict().items():
        assert got[name] == (pytest.approx(value, rel=1e-9) if value is not None else None), name
    exact = rows.select(F.count_distinct("note")).first()[0]
    assert abs(got["about_unique_note"] - exact) <= 0.05 * exact + 1


def test_profile_after_each_run(spark, tmp_path):
    table = TableStore(spark, str(tmp_path / "my table"), "month")
    profile = RunningProfile(table, TableStore(spark, str(tmp_path / "state")), ["v", "n", "d", "day", "note"], keys=["k"])
    with pytest.raises(FileNotFoundError):
        profile.refresh("r0")
    table.upsert(make(spark, range(300), 1), "k", "r1")
    assert_same(profile.refresh("r1"), table.read())
    table.upsert(make(spark, range(200, 420, 4), 2), "k", "r2")  # one month of four
    before = {r["__dir"] for r in profile.state.read().collect()}
    left = [d for _, d in table.current().dirs if d in before]
    assert left and len(left) < len(table.current().dirs)
    want = spark.createDataFrame(table.read().collect(), SCHEMA)
    for d in left:  # what an earlier run wrote is not read again
        shutil.rmtree(Path(table.path, d))
    assert_same(profile.refresh("r2"), want)
    version = profile.state.version()
    assert_same(profile.refresh("r3"), want)
    assert profile.state.version() == version  # nothing to do


def test_rebuilt_and_empty_tables(spark, tmp_path):
    table = TableStore(spark, str(tmp_path / "t"))
    state = TableStore(spark, str(tmp_path / "s"))
    profile = RunningProfile(table, state, ["v", "n", "d", "day", "note"], keys=["k"])
    table.overwrite(make(spark, range(0), 1), "r1")
    empty = profile.refresh("r1").first()
    assert empty["total_rows"] == empty["v_complete"] == empty["unique_k"] == empty["about_unique_note"] == 0 and empty["avg_v"] is None
    table.overwrite(make(spark, range(50), 1), "r2")
    assert_same(profile.refresh("r2"), table.read())
    table.overwrite(make(spark, range(1), 3), "r3")
    assert_same(profile.refresh("r3"), table.read())
    # other columns: the state is made anew
    few = RunningProfile(table, state, ["note"]).refresh("r4").first()
    assert few["total_rows"] == 1 and "v_complete" not in few.asDict()
