"""Raw text to staging, core, mart and the combined view: four lazy transformations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.functions.clock import local_date
from stateloom.functions.keys import business_key
from stateloom.operators.keys import unseen_in_store
from stateloom.operators.mapping import INGESTED_AT, LOAD_KEY, mapped_projection, run_stamp
from stateloom.plans.bank import REWARD_CATEGORY, REWARD_DESCRIPTION, Bank


def staging(raw: DataFrame, bank: Bank, run_ts: dt.datetime, existing: DataFrame | None = None) -> DataFrame:
    """Typed rows of the raw rows whose load key is not staged yet."""
    rows = raw if existing is None else unseen_in_store(raw, existing, LOAD_KEY)
    if bank.dedup_within_batch:
        rows = rows.dropDuplicates([LOAD_KEY])
    return mapped_projection(rows, bank.mapping, bank.source, run_ts)


# Fixed values in the three models below: names and order of their columns are the tables' contract.


def core(staged: DataFrame, bank: Bank, run_ts: dt.datetime) -> DataFrame:
    """Staged rows under their business key."""
    key = business_key(bank.source, "transacted_at_utc", "transaction_amt", "card_last4")
    return staged.select(
        key.alias("transaction_bk"),
        "card_last4",
        "status_nm",
        "category_nm",
        "description",
        "transaction_amt",
        "transaction_currency_cd",
        "transacted_at_utc",
        "total_rewards_amt",
        run_stamp(run_ts).alias(INGESTED_AT),
    )


def mart(core_rows: DataFrame, bank: Bank, run_ts: dt.datetime) -> DataFrame:
    """Successful transactions with their local date."""
    return core_rows.filter(F.col("status_nm") == "OK").select(
        "transaction_bk",
        "category_nm",
        "description",
        "transaction_amt",
        "transaction_currency_cd",
        "transacted_at_utc",
        local_date(F.col("transacted_at_utc"), bank.zone, bank.documented_date).alias("transaction_dt"),
        "total_rewards_amt",
        run_stamp(run_ts).alias(INGESTED_AT),
    )


def view_rows(bank: Bank) -> Column:
    """The payment row of a mart row, and a reward row if it earned one, as an array."""
    payment = F.struct(
        F.lit(bank.label).alias("bank_nm"),
        "category_nm",
        "description",
        "transaction_amt",
        "transaction_currency_cd",
        "transaction_dt",
    )
    reward = F.struct(
        F.lit(bank.label).alias("bank_nm"),
        F.lit(REWARD_CATEGORY).alias("category_nm"),
        F.lit(REWARD_DESCRIPTION).alias("description"),
        F.col("total_rewards_amt").alias("transaction_amt"),
        "transaction_currency_cd",
        "transaction_dt",
    )
    return F.when(F.col("total_rewards_amt") > 0, F.array(payment, reward)).otherwise(F.array(payment))


def combined_view(mart_rows: DataFrame, bank: Bank) -> DataFrame:
    """Payments, and a reward row beside every payment that earned one, from one pass over the mart."""
    return mart_rows.select(F.inline(view_rows(bank)))


def keyed_view(mart_rows: DataFrame, bank: Bank) -> DataFrame:
    """The combined view's rows under keys of their own, with the time their mart row was written."""
    rows = mart_rows.select("transaction_bk", INGESTED_AT, F.posexplode(view_rows(bank)).alias("place", "row"))
    return rows.select(F.concat_ws("#", "transaction_bk", "place").alias("row_key"), INGESTED_AT, "row.*")
