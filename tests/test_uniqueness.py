"""Uniqueness after a batch equals uniqueness of the whole table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stateloom.plans.bank import Bank
from stateloom.plans.build import build
from stateloom.plans.ingest import ingest
from stateloom.plans.warehouse import Warehouse
from stateloom.quality.checks import duplicate_keys, not_null, run_checks, unique
from stateloom.quality.gate import QualityError, enforce
from stateloom.quality.uniqueness import added_duplicates, failures_after, may_share_key

from .conftest import LATER, RUN1, RUN2, inbox, statement_row, write_statement


def keys(spark, values, kind="string"):
    return spark.createDataFrame([(v, 1) for v in values], f"`the key` {kind}, other int")


@pytest.mark.parametrize("kind", ["string", "bigint", "double"])
def test_same_verdict_as_the_whole_table(spark, kind):
    rng = random.Random(5)
    draw = {
        "string": lambda: rng.choice([None, "", "ä", *map(str, range(400))]),
        "bigint": lambda: rng.choice([None, 0, -(1 << 63), *range(400)]),
        "double": lambda: rng.choice([None, 0.0, -0.0, float("nan"), *[x / 4 for x in range(400)]]),
    }[kind]
    for n_stored, n_added in ((0, 50), (300, 0), (600, 200)):
        stored, added = keys(spark, [draw() for _ in range(n_stored)], kind), keys(spark, [draw() for _ in range(n_added)], kind)
        before = duplicate_keys(stored, "the key").count()
        whole = duplicate_keys(stored.union(added), "the key")
        assert failures_after(added, stored, "the key", before).first()["failures"] == whole.count()
        want = {str(r[0]): r[1] for r in whole.join(added.distinct(), "the key", "left_semi").collect()} if kind != "double" else None
        got = {str(r["the key"]): r["n_stored"] + r["n_added"] for r in added_duplicates(added, stored, "the key").collect()}
        assert want is None or got == want


def test_filter_passes_all_that_share_a_key_and_few_others(spark):
    stored = spark.range(400_000).select(F.col("id").cast("string").alias("k"))
    added = spark.range(399_000, 420_000).select(F.col("id").cast("string").alias("k"))
    passed = may_share_key(stored, added, "k")
    assert passed.join(added, "k", "left_semi").count() == 1000
    assert passed.count() < 1000 + 0.01 * 400_000


def test_store_is_not_shuffled(spark, tmp_path):
    """Between the store's scan and the first exchange stands the filter."""
    spark.range(10_000).withColumn("stored_only", F.lit(1)).write.parquet(str(tmp_path / "stored"))
    stored, added = spark.read.parquet(str(tmp_path / "stored")), spark.range(9_990, 10_010)
    plan = added_duplicates(added, stored, "id")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line)
    above = [line for line in reversed(lines[:at]) if "Exchange" in line or "BroadcastHashJoin" in line]
    assert "BroadcastHashJoin" in above[0] and "stored_only" not in lines[at]


def test_checks_of_added_rows(spark):
    stored, added = keys(spark, ["a", "b", "b", None]), keys(spark, ["a", "b", "c", "d", "d", None])
    report = run_checks(added, [unique("the key"), not_null("the key")], stored)
    assert {r["check_name"]: r["failures"] for r in report.collect()} == {"unique": 2, "not_null": 1}  # a and d; b was double before


def test_build_looks_for_added_load_keys_in_all_of_staging(spark, tmp_path):
    root = tmp_path / "data"
    warehouse, bank = Warehouse(spark, str(tmp_path / "house")), Bank()
    write_statement(inbox(root) / "a.csv", [statement_row("14.09.2025 13:02:41", "-955,00")])
    ingest(spark, warehouse, str(root), RUN1, "r1", LATER)
    build(spark, warehouse, bank, RUN1, "r1")
    write_statement(inbox(root) / "b.csv", [statement_row("15.09.2025 13:02:41", "-9,00")])
    ingest(spark, warehouse, str(root), RUN2, "r2", LATER)
    build(spark, warehouse, bank, RUN2, "r2")
    staging = warehouse.staging("t_bank")
    assert staging.read_others("r2").count() == 1 and staging.read_written("r2").count() == 1
    staging.append(staging.read_others("r2"), "r3")  # a stored row once more
    with pytest.raises(QualityError, match=r"unique\(__load_key\): 1"):
        enforce(staging.read_written("r3"), bank.checks["staging"], "staging", staging.read_others("r3"))
