"""The latest copy stays readable whenever a publish breaks."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stateloom.plans.upkeep import drop_old_copies
from stateloom.sinks.latest import LatestCopy

ROOT = Path(__file__).resolve().parents[1]

KILLED = """
import os, sys
from stateloom.session import build_session
from stateloom.sinks.latest import LatestCopy
spark = build_session("killed", master="local[2]", conf={"spark.ui.enabled": "false"})
copy = LatestCopy(spark, sys.argv[1])
if sys.argv[2] == "between":
    copy.point = lambda pointer: os._exit(9)
    copy.publish(spark.range(5).selectExpr("id", "'second' as v"), "r2")
else:
    def slow(batches):
        for batch in batches:
            yield batch
            os.kill(parent, 9)
    parent = os.getpid()
    copy.publish(spark.range(100_000).repartition(2).selectExpr("id", "'second' as v").mapInPandas(slow, "id long, v string"), "r2")
"""


def content(copy: LatestCopy) -> set:
    return {(r.id, r.v) for r in copy.read("id long, v string").collect()}


def test_readers_see_whole_copies(spark, tmp_path):
    copy = LatestCopy(spark, str(tmp_path / "bank_transactions.csv"))
    assert copy.current() is None
    with pytest.raises(FileNotFoundError):
        copy.read()
    first = copy.publish(spark.range(4).selectExpr("id", "'a,\"\n' as v"), "r1")
    assert (first.version, first.row_count) == (1, 4)
    pinned = copy.read("id long, v string")
    assert content(copy) == {(i, 'a,"\n') for i in range(4)}
    second = copy.publish(spark.range(2).selectExpr("id", "'b' as v"), "r1")
    assert (second.version, second.row_count) == (2, 2) and second.md5 != first.md5
    assert content(copy) == {(0, "b"), (1, "b")} and pinned.count() == 4
    third = copy.publish(spark.range(0).selectExpr("id", "'b' as v"), "r3")
    assert third.row_count == 0 and content(copy) == set()
    assert drop_old_copies(copy) == [first.folder]
    assert drop_old_copies(copy) == [] and content(copy) == set()


def test_failed_write_leaves_the_copy(spark, tmp_path):
    copy = LatestCopy(spark, str(tmp_path / "copy"))
    copy.publish(spark.range(3).selectExpr("id", "'first' as v"), "r1")
    broken = spark.range(0, 1000, 1, 4).selectExpr("id", "if(id = 900, raise_error('half-way'), 'second') as v")
    with pytest.raises(Exception, match="half-way"):
        copy.publish(broken, "r2")
    assert content(copy) == {(i, "first") for i in range(3)} and copy.current().version == 1
    assert copy.publish(spark.range(1).selectExpr("id", "'third' as v"), "r3").version == 2
    assert content(copy) == {(0, "third")}


@pytest.mark.parametrize("when", ["between", "writing"])
def test_killed_publish_leaves_the_copy(spark, tmp_path, when):
    copy = LatestCopy(spark, str(tmp_path / "copy"))
    first = copy.publish(spark.range(3).selectExpr("id", "'first' as v"), "r1")
    done = subprocess.run([sys.executable, "-c", KILLED, copy.path, when], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0
    assert copy.current() == first and content(copy) == {(i, "first") for i in range(3)}
    second = copy.publish(spark.range(1).selectExpr("id", "'third' as v"), "r3")
    assert content(copy) == {(0, "third")}
    # what the killed publish left goes with the old versions
    dropped = drop_old_copies(copy, keep=1)
    assert first.folder in dropped and [f for f in copy.version_folders()] == [second.folder]
    assert copy.read("id long, v string").agg(F.count("*")).first()[0] == 1
