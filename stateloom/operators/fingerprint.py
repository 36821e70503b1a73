"""Order-free fingerprints that combine map-side: nothing is gathered or sorted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.functions.keys import load_key


def _hex(text: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(text, start, length), 16, 10).cast("bigint")


def fold_md5(digest: Column) -> Column:
    """Aggregate: md5 over the count and the sums of the digests' two halves (60 bits of each)."""
    halves = [F.sum(_hex(digest, start, 15).cast("decimal(20,0)")) for start in (1, 17)]
    sums = [F.coalesce(half, F.lit(0).cast("decimal(30,0)")).cast("string") for half in halves]
    return F.md5(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *sums))


def row_checksum(df: DataFrame) -> DataFrame:
    """Row count and, as text, the sum of each row's first fifteen key digits."""
    digest = load_key(df)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(_hex(digest, 1, 15).cast("decimal(20,0)")).cast("string"), F.lit("0")).alias("row_checksum"),
    )
