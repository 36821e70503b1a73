"""Every operator as a query over the given tables: name -> (session, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.functions import (
    business_key, comma_decimal, date_text, double_text, int_text, load_key, local_date, local_text_to_utc,
    normalize_identifier,
)
from stateloom.functions.text import check_decimal
from stateloom.operators.fingerprint import fold_md5, row_checksum
from stateloom.operators.incremental import (
    after_bookmark, backfill_range, delete_insert, distinct_per_file, newest_bookmark, since_lookback,
)
from stateloom.operators.keys import already_seen, keyed_update, referential_integrity, unseen
from stateloom.operators.layout import display, display_tolerant, events_export, renamed, stringified
from stateloom.operators.mapping import INGESTED_AT, align, run_stamp
from stateloom.operators.retention import pending_archive, retention_plan
from stateloom.plans import models
from stateloom.plans.bank import Bank
from stateloom.plans.feed import (
    RUN_TS, core_feed, feed, mart_feed, raw_feed, staged_feed, table, view_feed,
)
from stateloom.plans.files import dialect_files, latest_copy, outbox_second_batch, running_profile
from stateloom.quality.checks import (
    between, column_exists, duplicate_keys, in_set, not_null, null_counts, rejected_values, row_rule, run_checks, unique,
)
from stateloom.quality.profile import completeness, export_counts, metrics, uniqueness, value_ranges
from stateloom.quality.quarantine import with_problems
from stateloom.quality.uniqueness import added_duplicates
from stateloom.sources.files import classify, ingest_summary

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the documented event expectations.
EVENT_TYPES = ["page_view", "click", "purchase", "signup"]
METRIC_RANGE = (0, 1000)


# -- scans and keys


def scan_table(spark, sf):
    return table(spark, sf, "orders")


def normalize_identifier_query(spark, sf):
    name = normalize_identifier(F.concat_ws("_", "p_brand", "p_type"))
    return table(spark, sf, "part").select("p_partkey", name.alias("table_name"))


def load_key_customer(spark, sf):
    rows = table(spark, sf, "customer")
    return rows.select("c_custkey", load_key(rows).alias("load_key"))


def load_key_documents(spark, sf):
    rows = table(spark, sf, "documents")
    return rows.select("doc_id", load_key(rows).alias("load_key"))


def load_key_events(spark, sf):
    rows = table(spark, sf, "events")
    return rows.select("event_id", load_key(rows).alias("load_key"))


def business_key_query(spark, sf):
    key = business_key("t_bank", "transacted_at_utc", "transaction_amt", "card_last4")
    return staged_feed(spark, sf).select("description", key.alias("transaction_bk"))


def business_key_large(spark, sf):
    """Amounts a thousand times as large, where plain and exponent text forms part ways."""
    key = business_key("t_bank", "o_orderdate", "o_totalprice * 1000", "cast(null as string)")
    return table(spark, sf, "orders").select(
        "o_orderkey", double_text("o_totalprice * 1000").alias("amount_text"), key.alias("transaction_bk")
    )


# -- projections


def align_schema(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("custkey"), F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("string").alias("nationkey"), double_text("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"),
    )
    supplier = table(spark, sf, "supplier").select(
        double_text("s_acctbal").alias("acctbal"), F.col("s_name").alias("name"),
        F.col("s_suppkey").cast("string").alias("suppkey"), F.col("s_nationkey").cast("string").alias("nationkey"),
    )
    return customer.unionByName(align(supplier, customer.columns))


def decimal_comma_parse(spark, sf):
    return feed(spark, sf).select(
        F.col("Описание").alias("description"),
        comma_decimal(F.col("`Сумма операции`")).alias("amount"),
        comma_decimal(F.col("`Бонусы (включая кэшбэк)`")).alias("reward"),
    )


def local_text_to_utc_query(spark, sf):
    return feed(spark, sf).select(
        F.col("Описание").alias("description"), local_text_to_utc(F.col("`Дата операции`")).alias("occurred_at")
    )


def date_text_parse(spark, sf):
    return feed(spark, sf).select(
        F.col("Описание").alias("description"), date_text(F.col("`Дата платежа`")).alias("posted_on")
    )


def int_text_parse(spark, sf):
    price = double_text("p_retailprice")
    return table(spark, sf, "part").select(
        "p_partkey",
        int_text(F.col("p_size").cast("string"), strict=True).alias("size_int"),
        int_text(price).alias("price_int"),
    )


def display_projection(spark, sf):
    return renamed(view_feed(spark, sf))


def display_projection_tolerant(spark, sf):
    return display_tolerant(view_feed(spark, sf).drop("description", "transaction_currency_cd"))


def stringify_cells(spark, sf):
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type")
    return stringified(
        table(spark, sf, "events").select("event_id", "ts", F.col("ts").cast("date").alias("day"), kind, "value")
    )


def local_date_literal(spark, sf):
    return table(spark, sf, "events").select("event_id", local_date(F.col("ts")).alias("local_dt"))


def local_date_documented(spark, sf):
    return table(spark, sf, "events").select("event_id", local_date(F.col("ts"), documented=True).alias("local_dt"))


def events_export_layout(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("id"), "user_id", "event_type", F.col("ts").alias("event_ts"),
        F.col("value").alias("metric_1"),
    )
    return events_export(events)


# -- models


def status_filter(spark, sf):
    return staged_feed(spark, sf).filter(F.col("status_nm") == "OK").select("description", "status_nm")


def snapshot_manifest(spark, sf):
    return row_checksum(view_feed(spark, sf))


# -- incremental


def middle_day(events: DataFrame) -> DataFrame:
    """One row: midnight of the day halfway through the table."""
    first, last = F.min("ts").cast("date"), F.max("ts").cast("date")
    return events.agg(F.date_add(first, F.floor(F.date_diff(last, first) / 2).cast("int")).cast("timestamp_ntz").alias("mid"))


def first_half(events: DataFrame) -> DataFrame:
    return events.filter(F.col("ts") < middle_day(events).scalar())


def bookmark_delta(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    # a bookmark is one stored row; as constants its values reach the scan
    mark = newest_bookmark(first_half(events), "ts", "event_id").first()
    last_ts = F.lit(mark["last_ts"].isoformat()).cast("timestamp_ntz")
    return after_bookmark(events, "ts", "event_id", last_ts, F.lit(mark["last_id"]))


def incremental_lookback(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return since_lookback(events, first_half(events), "ts")


def anti_join_new_rows(spark, sf):
    events = table(spark, sf, "events")
    keyed = events.select("event_id", "ts", load_key(events).alias("__load_key"))
    return unseen(keyed, first_half(keyed), "__load_key").select("event_id", "__load_key")


def page_files(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.col("url").alias("src_path"), F.md5("html").alias("md5"))


def page_ledger(spark, sf):
    """Pages seen under https before; those of odd length have changed since."""
    seen = table(spark, sf, "pages").filter(F.col("url").startswith("https:"))
    changed = F.length("html") % 2 == 1
    return seen.select(
        F.col("url").alias("src_path"),
        F.when(changed, F.md5(F.concat("html", F.lit("x")))).otherwise(F.md5("html")).alias("md5"),
    )


def ledger_anti_join(spark, sf):
    return unseen(page_files(spark, sf), page_ledger(spark, sf), ["src_path", "md5"]).select("page_id", "src_path", "md5")


def ledger_semi_join(spark, sf):
    skipped = already_seen(page_files(spark, sf), page_ledger(spark, sf), ["src_path", "md5"])
    return skipped.select("page_id", "src_path", "md5")


def ledger_summary(spark, sf):
    found = page_files(spark, sf).withColumn("modificationTime", F.lit("2020-01-01").cast("timestamp"))
    return ingest_summary(classify(found, page_ledger(spark, sf)))


def distinct_per_file_query(spark, sf):
    return distinct_per_file(table(spark, sf, "documents").select("source", "lang", "text"), "source")


def delete_insert_upsert(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    target = orders.filter(F.col("o_orderdate") < F.lit("1998-06-01").cast("timestamp_ntz"))
    batch = orders.filter(F.col("o_orderdate") >= F.lit("1998-05-01").cast("timestamp_ntz")).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    return delete_insert(target, batch, "o_orderkey")


EARLIER = "INTERVAL 3 DAYS"


def order_number() -> Column:
    """Of a feed row, from its description."""
    return F.substring_index("description", " ", -1).cast("bigint")


def staging_incremental(spark, sf):
    """Every second order is staged already; the build's anti join lets the others through."""
    stored = staged_feed(spark, sf).filter(order_number() % 2 == 0)
    return models.staging(raw_feed(spark, sf), Bank(), RUN_TS, stored)


def core_incremental(spark, sf):
    """A third of the orders is missing from core; every second one comes anew, in another category."""
    staged, stamp = staged_feed(spark, sf), run_stamp(RUN_TS)
    stored = models.core(staged.filter(order_number() % 3 != 0), Bank(), RUN_TS).withColumn(INGESTED_AT, stamp - F.expr(EARLIER))
    anew = order_number() % 2 == 0
    upstream = staged.withColumns({
        "category_nm": F.when(anew, F.lit("changed")).otherwise(F.col("category_nm")),
        INGESTED_AT: F.when(anew, stamp).otherwise(stamp - F.expr("INTERVAL 5 DAYS")),
    })
    return delete_insert(stored, models.core(since_lookback(upstream, stored), Bank(), RUN_TS), "transaction_bk")


def mart_incremental(spark, sf):
    """Every second order comes anew, half of these as failed: the mart keeps the old rows of those."""
    cored, stamp = core_feed(spark, sf), run_stamp(RUN_TS)
    stored = models.mart(cored, Bank(), RUN_TS).withColumn(INGESTED_AT, stamp - F.expr(EARLIER))
    upstream = cored.filter(order_number() % 2 == 0).withColumns({
        "status_nm": F.when(order_number() % 4 == 0, F.lit("FAILED")).otherwise(F.col("status_nm")), "category_nm": F.lit("changed"),
    })
    return delete_insert(stored, models.mart(since_lookback(upstream, stored), Bank(), RUN_TS), "transaction_bk")


def display_rows(spark, sf):
    return display(view_feed(spark, sf))


def snapshot_fold(spark, sf):
    pages = table(spark, sf, "pages").select(F.md5("html").alias("md5"))
    return pages.agg(F.count(F.lit(1)).alias("parts"), fold_md5(F.col("md5")).alias("md5"))


def backfill_range_query(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return backfill_range(events, "ts", "2024-01-10", "2024-01-12")


# -- state tables


def document_ledger(spark, sf):
    documents = table(spark, sf, "documents")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".csv"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    ingested = start + F.expr("make_dt_interval(0, 0, 0, doc_id)")
    return documents.select(
        F.col("source").alias("bank"),
        F.col("lang").alias("table_name"),
        name.alias("file_name"),
        F.concat(F.lit("To Parse/Bank/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"), name).alias("src_path"),
        F.col("n_chars").alias("size"),
        F.md5("text").alias("md5"),
        ingested.alias("ingested_at"),
        F.when(F.col("lang") == "en", ingested + F.expr("INTERVAL 1 HOUR")).alias("archived_at"),
    )


def pending_archive_query(spark, sf):
    return pending_archive(document_ledger(spark, sf)).select("src_path", "bank", "file_name", "md5", "archived_path", "ingested_at")


def keyed_update_query(spark, sf):
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".csv")).alias("file_name")
    archived = table(spark, sf, "labels").select(name)
    updated = keyed_update(document_ledger(spark, sf), archived, "file_name", {"archived_at": run_stamp(RUN_TS)})
    return updated.select("file_name", "md5", "ingested_at", "archived_at")


def retention_top_n(spark, sf):
    events = table(spark, sf, "events")
    folders = events.groupBy(
        F.col("event_type").alias("dataset"), F.replace(F.col("ts").cast("date").cast("string"), F.lit("-"), F.lit("")).alias("folder")
    ).agg(F.max("ts").alias("modified_at"))
    return retention_plan(folders)


# -- quality


def referential_integrity_query(spark, sf):
    orders = table(spark, sf, "orders").select((F.col("o_custkey") + 100).alias("customer_ref"))
    return referential_integrity(orders, table(spark, sf, "customer"), "customer_ref", "c_custkey")


def dq_completeness(spark, sf):
    return completeness(staged_feed(spark, sf), ["card_last4", "mcc_cd", "cashback_amt", "description"])


def dq_metrics(spark, sf):
    return metrics(staged_feed(spark, sf), ["card_last4", "cashback_amt", "status_nm"], "transaction_amt", 4)


def dq_range(spark, sf):
    outside = (F.col("l_discount") < 0) | (F.col("l_discount") > 0.05)
    return value_ranges(table(spark, sf, "lineitem"), ["l_extendedprice", "l_discount"], {"invalid_discounts": outside})


def dq_uniqueness(spark, sf):
    return uniqueness(table(spark, sf, "documents"), ["doc_id", "text"])


def export_contract_counts(spark, sf):
    rows = feed(spark, sf)
    return export_counts(rows, check_decimal(F.col("`Сумма операции`")), check_decimal(F.col("`Кэшбэк`")))


def dq_not_null(spark, sf):
    return null_counts(staged_feed(spark, sf))


def dq_unique(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey")


def dq_unique_added(spark, sf):
    """Orders whose lines shipped since 1998 meet other lines of theirs: the older lines are the stored ones."""
    lines = table(spark, sf, "lineitem")
    since = F.lit("1998-01-01").cast("timestamp_ntz")
    older = ~F.coalesce(F.col("l_shipdate") >= since, F.lit(False))
    return added_duplicates(lines.filter(~older), lines.filter(older), "l_orderkey")


def dq_accepted_values(spark, sf):
    return rejected_values(table(spark, sf, "events"), "event_type", EVENT_TYPES)


def dq_expectations(spark, sf):
    checks = [
        column_exists("event_id"), column_exists("metric_2"), not_null("event_id"), not_null("user_id"),
        not_null("event_type"), in_set("event_type", EVENT_TYPES), between("value", *METRIC_RANGE),
        between("user_id", low=100, severity="warn"), unique("event_id"), unique("user_id", severity="warn"),
    ]
    return run_checks(table(spark, sf, "events"), checks)


def dq_row_rules(spark, sf):
    rows = feed(spark, sf).select(
        check_decimal(F.col("`Сумма операции`")).alias("amount"),
        check_decimal(F.col("`Сумма платежа`")).alias("payment"),
        check_decimal(F.col("`Сумма операции с округлением`")).alias("rounded"),
        check_decimal(F.col("`Бонусы (включая кэшбэк)`")).alias("bonuses"),
        F.col("`Валюта операции`").alias("currency"),
        F.col("`Валюта платежа`").alias("payment_currency"),
        F.col("MCC").alias("mcc"),
    )
    rules = {
        "payment_equals_amount": "payment = amount",
        "rounded_is_size": "rounded = abs(amount)",
        "currencies_align": "currency = payment_currency",
        "mcc_is_digits": "mcc is null or mcc = '' or mcc rlike '^[0-9]+$'",
        "bonuses_not_negative": "bonuses >= 0",
    }
    return run_checks(rows, [row_rule(name, rule) for name, rule in rules.items()])


def quarantine_bad_values(spark, sf):
    """Every 97th amount is a word, some others Java-only numbers, some descriptions blank."""
    key = F.substring_index("Описание", " ", -1).cast("bigint")
    amount = F.col("`Сумма операции`")
    rows = feed(spark, sf).select(
        key.alias("order_key"),
        F.when(key % 97 == 0, F.lit("invalid")).when(key % 89 == 0, F.concat(amount, F.lit("d"))).when(key % 79 == 0, F.lit("0x1p3")).otherwise(amount).alias("amount"),
        F.when(key % 83 != 0, F.col("Описание")).otherwise(F.lit(" ")).alias("description"),
    )
    return with_problems(rows, ["amount"], ["description"]).withColumn(
        "parsed", comma_decimal(F.col("amount"), lenient=True)
    )


QUERIES: dict[str, Query] = {
    "scan_table": scan_table,
    "normalize_identifier": normalize_identifier_query,
    "snapshot_manifest": snapshot_manifest,
    "bookmark_delta": bookmark_delta,
    "load_key_customer": load_key_customer,
    "load_key_documents": load_key_documents,
    "load_key_events": load_key_events,
    "align_schema": align_schema,
    "mapped_projection": staged_feed,
    "decimal_comma_parse": decimal_comma_parse,
    "local_text_to_utc": local_text_to_utc_query,
    "date_text_parse": date_text_parse,
    "int_text_parse": int_text_parse,
    "display_projection": display_projection,
    "stringify_cells": stringify_cells,
    "display_projection_tolerant": display_projection_tolerant,
    "business_key": business_key_query,
    "business_key_large": business_key_large,
    "local_date_literal": local_date_literal,
    "local_date_documented": local_date_documented,
    "events_export_layout": events_export_layout,
    "status_filter": status_filter,
    "pending_archive": pending_archive_query,
    "incremental_lookback": incremental_lookback,
    "anti_join_new_rows": anti_join_new_rows,
    "ledger_anti_join": ledger_anti_join,
    "ledger_semi_join": ledger_semi_join,
    "ledger_summary": ledger_summary,
    "referential_integrity": referential_integrity_query,
    "keyed_update": keyed_update_query,
    "core_model": core_feed,
    "mart_model": mart_feed,
    "union_reward_rows": view_feed,
    "distinct_per_file": distinct_per_file_query,
    "delete_insert_upsert": delete_insert_upsert,
    "staging_incremental": staging_incremental,
    "core_incremental": core_incremental,
    "mart_incremental": mart_incremental,
    "display_rows": display_rows,
    "snapshot_fold": snapshot_fold,
    "backfill_range": backfill_range_query,
    "dq_completeness": dq_completeness,
    "dq_metrics": dq_metrics,
    "dq_range": dq_range,
    "dq_uniqueness": dq_uniqueness,
    "export_contract_counts": export_contract_counts,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_unique_added": dq_unique_added,
    "dq_accepted_values": dq_accepted_values,
    "dq_expectations": dq_expectations,
    "dq_row_rules": dq_row_rules,
    "quarantine_bad_values": quarantine_bad_values,
    "retention_top_n": retention_top_n,
    "dialect_files": dialect_files,
    "latest_copy": latest_copy,
    "outbox_second_batch": outbox_second_batch,
    "running_profile": running_profile,
}
