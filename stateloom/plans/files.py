"""Queries that write files of the given tables into the shared folder and read them back by the library's ways."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom.operators.mapping import run_stamp
from stateloom.plans.feed import RUN_TS, table
from stateloom.quality.running import RunningProfile
from stateloom.session import shared_folder
from stateloom.sinks.latest import LatestCopy
from stateloom.sinks.outbox import Outbox
from stateloom.sinks.tables import TableStore
from stateloom.sources.dialects import Dialect
from stateloom.sources.files import find_files, with_digests
from stateloom.sources.headers import column_names
from stateloom.sources.statements import read_group

DIALECTS = [Dialect(","), Dialect(";"), Dialect("\t", "'", "'"), Dialect("|", '"', "\\"), Dialect(";", "'", "\\")]
# names that hold separators and quotes of other dialects
ORDER_HEADER = {"o_orderkey": "key; id", "o_orderstatus": "status | state", "note": "clerk's \"note\", text"}
NOTE = "concat(o_orderpriority, '; it''s \"', cast(o_custkey as string), '\", ', o_orderstatus)"


def dialect_files(spark, sf):
    """Orders dealt to files of five dialects, told apart by their content alone."""
    folder = shared_folder(spark, "dialects")
    orders = table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderstatus", f"{NOTE} as note")
    for number, dialect in enumerate(DIALECTS):
        rows = orders.filter(F.col("o_orderkey") % len(DIALECTS) == number).select(*[F.col(c).alias(name) for c, name in ORDER_HEADER.items()])
        writer = rows.write.option("header", True).option("quoteAll", True).option("sep", dialect.separator)
        writer.option("quote", dialect.quote).option("escape", dialect.escape).csv(f"{folder}/{number}")
    found = with_digests(find_files(spark, folder, "part-*"))
    kinds = found.filter("header <> ''").groupBy("header", "separator", "quote", "escape", "quoted_breaks").agg(F.collect_list("path").alias("paths"))
    frames = []
    for kind in kinds.collect():  # one row per way of writing
        dialect = Dialect(kind.separator, kind.quote, kind.escape)
        columns = column_names(kind.header, dialect)
        read = read_group(spark, kind.paths, columns, dialect, kind.quoted_breaks)
        frames.append(read.select(*[F.col(f"`{name}`").alias(alias) for alias, name in zip(("order_key", "status", "note"), ORDER_HEADER.values())]))
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], "order_key string, status string, note string")


def latest_copy(spark, sf):
    """What readers see while a second publish has written its version and not yet its pointer."""
    copy = LatestCopy(spark, shared_folder(spark, "latest"))
    customers = table(spark, sf, "customer").selectExpr("c_custkey", "concat(' ', c_name, ' ') as name", "c_acctbal")
    copy.publish(customers, "first")
    copy.write(customers.withColumn("c_acctbal", -F.col("c_acctbal")), "second")
    return copy.read("c_custkey bigint, name string, c_acctbal string").selectExpr("c_custkey", "name", "cast(c_acctbal as double) as c_acctbal")


def outbox_second_batch(spark, sf):
    """Half of the events are staged, then all of them with every seventh changed: what the second batch holds."""
    outbox = Outbox(spark, shared_folder(spark, "outbox"), "events")
    events = table(spark, sf, "events")
    first = F.col("event_id") % 2 == 0
    changed = F.when(F.col("event_id") % 7 == 0, F.upper("event_type")).otherwise(F.col("event_type"))

    def due(rows: DataFrame, kind, after: int) -> DataFrame:
        stamp = run_stamp(RUN_TS + dt.timedelta(hours=after)).alias("stamp")
        return rows.select(F.col("event_id").cast("string").alias("row_key"), stamp, F.array(kind, F.col("user_id").cast("string")).alias("cells"))

    outbox.stage(due(events.filter(first), F.col("event_type"), 0), "first")
    before = outbox.staged().select("batch").distinct()
    outbox.stage(due(events, changed, 1), "second")
    rows = outbox.staged().join(before, "batch", "left_anti")
    return rows.select(F.col("row_key").cast("bigint").alias("event_id"), F.col("cells")[0].alias("event_type"), F.col("cells")[1].alias("user_text"))


def running_profile(spark, sf):
    """Profile of an event table that was written in two runs; the second one measures what it has written only."""
    folder = shared_folder(spark, "profile")
    events, day = TableStore(spark, f"{folder}/events", "cast(cast(ts as date) as string)"), F.dayofmonth("ts")
    profile = RunningProfile(events, TableStore(spark, f"{folder}/state"), ["event_type", "value", "ts"], keys=["event_id"])
    rows = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    events.upsert(rows.filter(day % 3 != 0), "event_id", "first")
    profile.refresh("first")
    events.upsert(rows.filter(day % 3 != 1), "event_id", "second")  # some days again, some for the first time
    merged = profile.refresh("second")
    rounded = [F.round(c, 6).alias(c) for c in ("avg_value", "value_stddev")]
    same = ["total_rows", "unique_event_id", *[f"{c}_complete" for c in ("event_type", "value", "ts")], "min_event_type", "max_event_type", "min_value", "max_value", "min_ts", "max_ts"]
    return merged.select(*same, *rounded)
