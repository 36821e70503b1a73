"""CSV snapshots with a checksum manifest."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stateloom.quality.gate import ContractError
from stateloom.session import checkpoint
from stateloom.sinks.latest import LatestCopy, folder_md5, part_files, write_csv

# The keys of a manifest.
MANIFEST_KEYS = (
    "table", "csv_path", "results_path", "row_count", "md5", "results_md5", "created_at_utc", "date_folder", "timestamp"
)


def publish_snapshot(
    df: DataFrame, table: str, exports: str, results: str, run_ts: dt.datetime, materialize: bool = True
) -> dict:
    """Write the dated snapshot and the latest copy; return the manifest, which is stored as JSON.

    Both copies are folders of part files. The latest copy is the last to change, by its pointer: until
    then its readers see the one before. `materialize` evaluates the frame once for both; leave
    it off for a frame that reads stored tables only and gives the same rows each time.
    """
    spark = df.sparkSession
    date_folder, stamp = run_ts.strftime("%Y%m%d"), run_ts.strftime("%Y%m%d_%H%M%S")
    name = table.replace(".", "_")
    csv_path = f"{exports.rstrip('/')}/{date_folder}/{name}_{stamp}.csv"
    latest = LatestCopy(spark, f"{results.rstrip('/')}/bank_transactions.csv")
    rows = checkpoint(df) if materialize else df
    seen = Observation()
    write_csv(rows.observe(seen, F.count(F.lit(1)).alias("rows")), csv_path)  # counted while written
    written = latest.write(rows, stamp)
    manifest = {
        "table": table,
        "csv_path": csv_path,
        "results_path": f"{latest.path}/{written.folder}",
        "row_count": seen.get["rows"],
        "md5": folder_md5(spark, csv_path),
        "results_md5": written.md5,
        "created_at_utc": run_ts.isoformat(timespec="seconds") + "Z",
        "date_folder": date_folder,
        "timestamp": stamp,
    }
    target = f"{exports.rstrip('/')}/{date_folder}/{name}_manifest_{stamp}.json"
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(target)
    latest.point(written)
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def check_manifest(spark: SparkSession, manifest: dict) -> None:
    """Keys, a positive count, checksums of 32 digits, and as many rows in the snapshot as it says."""
    missing = [k for k in MANIFEST_KEYS if k not in manifest]
    if missing:
        raise ContractError(f"manifest lacks {missing}")
    if manifest["row_count"] <= 0 or len(manifest["md5"]) != 32 or len(manifest["results_md5"]) != 32:
        raise ContractError("manifest holds no rows or a malformed checksum")
    stored = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(manifest["csv_path"])
    ).count()
    if stored != manifest["row_count"]:
        raise ContractError(f"manifest says {manifest['row_count']} rows, the snapshot holds {stored}")


def check_header(spark: SparkSession, folder: str, expected: list[str]) -> None:
    """Every part file starts with exactly the expected header."""
    line = F.regexp_replace("header", "\r$", "")
    parsed = F.from_csv(line, F.lit(", ".join(f"c{k} string" for k in range(len(expected) + 1))), {"escape": '"'})
    names = F.array(*[parsed[f"c{k}"] for k in range(len(expected))])
    same = (names == F.array(*[F.lit(name) for name in expected])) & parsed[f"c{len(expected)}"].isNull()
    if not part_files(spark, folder).filter(~F.coalesce(same, F.lit(False))).isEmpty():
        raise ContractError(f"{folder}: a part's header is not {expected}")
