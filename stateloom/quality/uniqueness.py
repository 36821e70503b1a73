"""Uniqueness of a key kept up with each batch, without counting the whole table again.

The stored rows that can share a key with a batch are found by a Bloom filter over the batch's keys:
64-bit words, four bits a key in one word. It is a table of at most WORDS rows, whatever the batch
holds, and so safe to broadcast; the store is scanned and not shuffled. What passes is then counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.functions.keys import quoted

# the size of the filter: 2^19 rows of two longs; a batch of more keys than that only lets more stored rows through
WORDS = 1 << 19
BITS = 4
_WORD, _MASK, _SET = "__word", "__mask", "__set"


def _word(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(WORDS))


def _mask(key: Column) -> Column:
    second = F.xxhash64(key, F.lit("bits"))
    mask = F.lit(0).cast("bigint")
    for n in range(BITS):
        place = F.shiftrightunsigned(second, 6 * n).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return mask


def may_share_key(rows: DataFrame, others: DataFrame, column: str) -> DataFrame:
    """Rows whose key may occur in `others`: all that do, and few that do not. A NULL key never does."""
    key = F.col(quoted(column))
    words = others.filter(key.isNotNull()).select(_word(key).alias(_WORD), _mask(key).alias(_MASK))
    words = words.groupBy(_WORD).agg(F.bit_or(_MASK).alias(_SET))
    marked = rows.filter(key.isNotNull()).withColumns({_WORD: _word(key), _MASK: _mask(key)})
    hits = marked.join(F.broadcast(words), _WORD).filter(F.col(_SET).bitwiseAND(F.col(_MASK)) == F.col(_MASK))
    return hits.drop(_WORD, _MASK, _SET)


def added_duplicates(batch: DataFrame, stored: DataFrame, column: str) -> DataFrame:
    """Keys of `batch` that occur more than once in both together: the key, n_stored, n_added. NULL is not a key."""
    key = quoted(column)
    added = batch.filter(F.col(key).isNotNull()).groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("n_added"))
    found = may_share_key(stored.select(F.col(key)), batch.select(F.col(key)), column)
    found = found.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("n_stored"))
    both = added.join(found, column, "left").select(
        F.col(key), F.coalesce("n_stored", F.lit(0).cast("bigint")).alias("n_stored"), "n_added"
    )
    return both.filter(F.col("n_stored") + F.col("n_added") > 1)


def failures_after(batch: DataFrame, stored: DataFrame, column: str, before: int = 0) -> DataFrame:
    """One row, `failures`: the duplicate keys of stored and batch together, of which `before` were in stored alone."""
    new = F.count_if(F.col("n_stored") <= 1)
    return added_duplicates(batch, stored, column).agg((F.lit(before).cast("bigint") + new).alias("failures"))
