"""What to keep, what to archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Snapshot folders kept, and the folder a source file moves between.
KEEP_SNAPSHOTS = 10
INBOX, ARCHIVE = "To Parse", "Archive"


def dated_folder(name: Column) -> Column:
    """Whether a folder name is a real date written YYYYMMDD."""
    return name.rlike("^[0-9]{8}$") & F.try_to_date(name, "yyyyMMdd").isNotNull()


def newest_n(df: DataFrame, by: Sequence[str], newest: Sequence[Column], n: int) -> DataFrame:
    """The first `n` rows per group.

    The row-number limit runs inside each input partition before the shuffle, so a group sends at
    most `n` rows per partition however large it is.
    """
    window = Window.partitionBy(*by).orderBy(*newest)
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") <= n).drop("__rn")


def retention_plan(
    folders: DataFrame, dataset: str = "dataset", folder: str = "folder", modified: str = "modified_at",
    keep: int = KEEP_SNAPSHOTS,
) -> DataFrame:
    """One row per dated folder with `action` keep or delete; other folders are left out.

    The keep list is bounded per dataset, and the plan looks every folder up in it instead of
    numbering a whole dataset in one task.
    """
    dated = folders.filter(dated_folder(F.col(folder)))
    kept = newest_n(dated, [dataset], [F.col(modified).desc(), F.col(folder).desc()], keep)
    kept = kept.select(F.col(dataset).alias("__dataset"), F.col(folder).alias("__folder"), F.lit(True).alias("__keep"))
    # null-safe, so that neither side gains a filter and both read one shared exchange
    same = F.col(dataset).eqNullSafe(F.col("__dataset")) & F.col(folder).eqNullSafe(F.col("__folder"))
    marked = dated.join(kept, same, "left")
    action = F.when(F.col("__keep"), F.lit("keep")).otherwise(F.lit("delete"))
    return marked.withColumn("action", action).select(*folders.columns, "action")


def pending_archive(ledger: DataFrame) -> DataFrame:
    """Ledger rows not archived yet, oldest first, with the path each file moves to."""
    return (
        ledger.filter(F.col("archived_at").isNull())
        .withColumn("archived_path", F.replace(F.col("src_path"), F.lit(INBOX), F.lit(ARCHIVE)))
        .orderBy("ingested_at", "src_path", "md5")
    )
