"""Joins on key existence, built so that one hot key cannot fill one task.

The looked-up side is reduced to one row per key with map-side combining first, so copies of a
key collapse before they are shuffled. That reduction is clustered on (key, bucket) rather than on
the key, which leaves the join with an exchange of its own on either side: adaptive execution can
then split a hot partition of the left side. No side carries a broadcast hint; at run time Spark
broadcasts the keys only when their measured size is under its threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUCKET = "__key_bucket"


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def distinct_keys(df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """One row per key. The bucket is a function of the key, so it adds no rows."""
    names = _names(on)
    bucket = F.pmod(F.xxhash64(*names), F.lit(1024)).alias(_BUCKET)
    return df.select(*names, bucket).distinct().drop(_BUCKET)


def unseen(df: DataFrame, seen: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of `df` whose key does not occur in `seen`. A NULL key is never seen."""
    return df.join(distinct_keys(seen, on), _names(on), "left_anti")


def unseen_in_store(batch: DataFrame, stored: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """`unseen` for a batch that is small beside what is stored.

    The stored keys are first cut down to those of the batch. The batch's keys are the side that a
    hash join may broadcast there, so while they are small the store is only scanned, not shuffled.
    """
    hits = already_seen(stored.select(*_names(on)), batch, on)
    return unseen(batch, hits, on)


def already_seen(df: DataFrame, seen: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of `df` whose key occurs in `seen`."""
    return df.join(distinct_keys(seen, on), _names(on), "left_semi")


def keyed_update(
    df: DataFrame, keys: DataFrame, on: str | Sequence[str], changes: dict[str, Column]
) -> DataFrame:
    """Set columns on every row whose key occurs in `keys`; other rows pass through."""
    hit = "__hit"
    marked = df.join(distinct_keys(keys, on).withColumn(hit, F.lit(True)), _names(on), "left")
    return marked.select(
        *[
            (F.when(F.col(hit), changes[name]).otherwise(F.col(name)).alias(name) if name in changes else F.col(name))
            for name in df.columns
        ]
    )


def referential_integrity(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """Row counts of child left-joined to parent: in all, with a parent, without one.

    Both sides are counted per key before they meet, so the join sees one row per key and the
    products of the counts stand for the joined rows.
    """
    children = child.groupBy(F.col(child_key).alias("__key")).agg(F.count(F.lit(1)).alias("__children"))
    parents = (
        parent.filter(F.col(parent_key).isNotNull())
        .groupBy(F.col(parent_key).alias("__key"))
        .agg(F.count(F.lit(1)).alias("__parents"))
    )
    joined = children.join(parents, "__key", "left")
    pairs = F.col("__children") * F.coalesce(F.col("__parents"), F.lit(1))
    found = F.col("__parents").isNotNull()
    zero = F.lit(0).cast("bigint")
    return joined.agg(
        F.coalesce(F.sum(pairs), zero).alias("total_rows"),
        F.coalesce(F.sum(F.when(found, pairs)), zero).alias("valid_references"),
        F.coalesce(F.sum(F.when(~found, pairs)), zero).alias("invalid_references"),
    )
