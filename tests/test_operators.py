"""Joins, upserts, bookmarks, layouts and retention on small frames, with a hot key forced."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stateloom.operators.fingerprint import fold_md5, row_checksum
from stateloom.operators.incremental import backfill_range, delete_insert, distinct_per_file, since_lookback
from stateloom.operators.keys import already_seen, keyed_update, referential_integrity, unseen, unseen_in_store
from stateloom.operators.layout import DISPLAY_COLUMNS, display, display_tolerant, events_export, header
from stateloom.operators.mapping import MappingRow, align, rows_for, run_stamp
from stateloom.operators.retention import pending_archive, retention_plan
from stateloom.plans.bank import Bank
from stateloom.plans.models import combined_view, staging

from .conftest import RUN1, tuples


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before: dict = {}

    def put(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_hot_key_is_split_and_nothing_is_lost(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"), F.md5(F.col("id").cast("string")).alias("v")
    )
    seen = spark.range(0, 150_000, 1, 8).select(F.col("id").alias("key")).unionAll(
        spark.range(0, 100_000, 1, 8).select(F.lit(5).cast("bigint").alias("key"))
    )
    new = unseen(rows, seen, "key")
    assert new.count() == 200_000
    collected = new.agg(F.count_if(F.col("key") == -1), F.count_distinct("v")).first()
    assert tuple(collected) == (100_000, 200_000)
    frame = unseen(rows, seen, "key").select(F.length("v").alias("n"))
    frame.collect()
    assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()
    assert already_seen(rows, seen, "key").count() == 100_000


def test_unseen_and_seen_partition_rows(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), (None, "1")], "path string, md5 string")
    ledger = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "9")], "path string, md5 string")
    assert tuples(unseen(df, ledger, ["path", "md5"])) == sorted([("a", "2"), ("b", "1"), (None, "1")], key=repr)
    assert tuples(unseen_in_store(df, ledger, ["path", "md5"])) == tuples(unseen(df, ledger, ["path", "md5"]))
    assert tuples(already_seen(df, ledger, ["path", "md5"])) == [("a", "1")]


def test_keyed_update_hits_every_row_of_a_path(spark):
    df = spark.createDataFrame([("a", "old", None), ("a", "new", None), ("b", "x", 5)], "path string, md5 string, n int")
    keys = spark.createDataFrame([("a",), ("a",)], "path string")
    assert tuples(keyed_update(df, keys, "path", {"n": F.lit(1)})) == [("a", "new", 1), ("a", "old", 1), ("b", "x", 5)]


def test_referential_integrity(spark):
    child = spark.createDataFrame([(1, 1), (2, 2), (3, 99)], "id int, category_id int")
    parent = spark.createDataFrame([(1, "Food"), (2, "Transport"), (3, "Fun")], "id int, name string")
    assert tuple(referential_integrity(child, parent, "category_id", "id").first()) == (3, 2, 1)
    # a parent key held twice joins twice, a NULL reference joins nothing
    child = child.unionByName(spark.createDataFrame([(4, None)], "id int, category_id int"))
    doubled = parent.unionByName(parent.limit(1)).unionByName(spark.createDataFrame([(None, "x")], "id int, name string"))
    joined = child.alias("c").join(doubled.alias("p"), F.col("c.category_id") == F.col("p.id"), "left")
    want = joined.agg(F.count("*"), F.count("p.id"), F.count_if(F.col("p.id").isNull())).first()
    assert tuple(referential_integrity(child, doubled, "category_id", "id").first()) == tuple(want)
    assert tuple(referential_integrity(child.limit(0), parent, "category_id", "id").first()) == (0, 0, 0)


def test_lookback(spark):
    at = lambda day: dt.datetime(2024, 1, day)
    upstream = spark.createDataFrame([(at(d),) for d in (1, 5, 6, 7)], "__ingested_at timestamp_ntz")
    target = upstream.filter("__ingested_at <= '2024-01-06'")
    assert tuples(since_lookback(upstream, target)) == [(at(5),), (at(6),), (at(7),)]
    assert since_lookback(upstream, target.limit(0)).count() == 4


def test_delete_insert_keeps_duplicates_of_the_batch(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    batch = spark.createDataFrame([("b", 2), ("b", 3), ("c", 2)], "k string, v int")
    assert tuples(delete_insert(target, batch, "k")) == [("a", 1), ("b", 2), ("b", 3), ("c", 2)]


def test_distinct_within_but_not_across_files(spark):
    df = spark.createDataFrame([("f1", "x"), ("f1", "x"), ("f2", "x")], "file string, v string")
    assert tuples(distinct_per_file(df, "file")) == [("f1", "x"), ("f2", "x")]


def test_backfill_range_includes_both_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, h),) for d, h in ((1, 23), (2, 0), (3, 23), (4, 0))], "t timestamp_ntz")
    assert backfill_range(df, "t", dt.date(2024, 1, 2), "2024-01-03").count() == 2


def test_align_and_mapping_rows(spark):
    df = spark.createDataFrame([("1", "2", "3")], "Id string, extra string, name string")
    assert align(df, ["id", "name"]).first().asDict() == {"id": None, "name": "3"}
    rows = [MappingRow("b", "z", " x ;\r"), MappingRow("b", "a", "y"), MappingRow("c", "q", "w")]
    assert rows_for(rows, "b") == [("a", "y"), ("z", "x ")]
    stamp = spark.range(1).select(run_stamp(dt.datetime(2024, 1, 1, 3, tzinfo=dt.timezone(dt.timedelta(hours=3))))).first()[0]
    assert stamp == dt.datetime(2024, 1, 1)


def test_display_layouts(spark):
    df = spark.createDataFrame(
        [("Chase", dt.date(2025, 1, 15), "USD", "Food", None, 45.5, "x")],
        "bank_nm string, transaction_dt date, transaction_currency_cd string, category_nm string, description string, "
        "transaction_amt double, extra string",
    )
    want = ["2025-01-15", "Chase", "Food", "None", "45.5", "USD"]
    assert display(df).columns == header() == list(DISPLAY_COLUMNS.values())
    assert list(display(df).first()) == list(display_tolerant(df).first()) == want
    few = df.select("transaction_dt", "bank_nm", "transaction_amt")
    assert list(display_tolerant(few).first()) == ["2025-01-15", "Chase", "", "", "45.5", ""]
    with pytest.raises(Exception, match="category_nm"):
        display(few)
    assert events_export(spark.createDataFrame([(1, 2)], "id int, event_ts int")).columns == ["id", "updated_at"]


def test_retention_and_archive_plans(spark):
    folders = [("d", f"202401{d:02d}", dt.datetime(2024, 1, d)) for d in range(1, 13)]
    folders += [("d", "notes", dt.datetime(2025, 1, 1)), ("d", "20241399", dt.datetime(2025, 1, 1)), (None, "20240101", dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(folders, "dataset string, folder string, modified_at timestamp_ntz")
    plan = {(r.dataset, r.folder): r.action for r in retention_plan(df).collect()}
    assert len(plan) == 13 and plan[(None, "20240101")] == "keep"
    assert sorted(f for (d, f), a in plan.items() if a == "delete") == ["20240101", "20240102"]
    ledger = spark.createDataFrame(
        [("To Parse/To Parse.csv", "m", dt.datetime(2024, 1, 2), None), ("To Parse/b", "m", dt.datetime(2024, 1, 1), None), ("c", "m", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
        "src_path string, md5 string, ingested_at timestamp_ntz, archived_at timestamp_ntz",
    )
    assert [r.archived_path for r in pending_archive(ledger).collect()] == ["Archive/b", "Archive/Archive.csv"]


def test_fingerprints_ignore_order_but_not_copies(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "v string")
    fold = lambda frame: frame.agg(fold_md5(F.md5("v"))).first()[0]
    assert fold(df) == fold(df.orderBy(F.desc("v"))) != fold(df.distinct())
    assert len(fold(df.limit(0))) == 32
    assert tuple(row_checksum(df.limit(0)).first()) == (0, "0")
    assert row_checksum(df).first() == row_checksum(df.repartition(3)).first()


def test_combined_view_has_a_row_per_reward(spark):
    rows = [("c1", "d1", -5.0, "RUB", dt.date(2024, 1, 1), r) for r in (1.0, 0.0, None, -1.0)]
    mart = spark.createDataFrame(
        rows, "category_nm string, description string, transaction_amt double, transaction_currency_cd string, transaction_dt date, total_rewards_amt double"
    )
    view = combined_view(mart, Bank())
    payment, reward = ("T Bank", "c1", "d1", -5.0), ("T Bank", "Cashback", "Cashback and other rewards", 1.0)
    assert tuples(view, "bank_nm", "category_nm", "description", "transaction_amt") == sorted([payment] * 4 + [reward], key=repr)


def test_staging_options(spark):
    raw = spark.createDataFrame([("k1", "x"), ("k1", "x"), ("k2", "y")], "__load_key string, v string")
    mapping = [MappingRow("b", "value", "upper(v)")]
    stored = raw.filter("v = 'y'").select("__load_key")
    assert tuples(staging(raw, Bank("b", mapping=mapping), RUN1, stored)) == [("k1", "X", RUN1)] * 2
    deduped = staging(raw, Bank("b", mapping=mapping, dedup_within_batch=True), RUN1)
    assert tuples(deduped) == [("k1", "X", RUN1), ("k2", "Y", RUN1)]
