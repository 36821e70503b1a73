"""Where the tables of one warehouse live."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.sinks.outbox import Outbox
from stateloom.sinks.tables import TableStore

LEDGER_SCHEMA = (
    "bank string, table_name string, file_name string, src_path string, size bigint, md5 string, "
    "ingested_at timestamp_ntz, archived_at timestamp_ntz, run_id string"
)
# a business key holds the UTC time, so equal keys share a month
MONTH = "substring(cast(transacted_at_utc as string), 1, 7)"


class Warehouse:
    """Stores of raw, ledger, staging, core, mart and bookmarks below one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def _store(self, name: str, partition_by: str | None = None) -> TableStore:
        return TableStore(self.spark, f"{self.path}/{name}", partition_by)

    def raw(self, table_name: str) -> TableStore:
        return self._store(f"raw/{table_name}")

    def ledger(self) -> TableStore:
        return self._store("meta/ingest_ledger")

    def bookmarks(self) -> TableStore:
        return self._store("meta/export_bookmark")

    def outbox(self, source: str) -> Outbox:
        return Outbox(self.spark, f"{self.path}/outbox", f"{source}_transactions")

    def staging(self, source: str) -> TableStore:
        return self._store(f"stg/{source}_transactions")

    def set_aside(self, source: str) -> TableStore:
        return self._store(f"quarantine/{source}_transactions")

    def core(self, source: str) -> TableStore:
        return self._store(f"core/{source}_transactions", MONTH)

    def mart(self, source: str) -> TableStore:
        return self._store(f"mart/{source}_transactions", MONTH)

    def replays(self, source: str) -> TableStore:
        return self._store(f"meta/{source}_replays")

    def ledger_rows(self) -> DataFrame:
        rows = self.ledger().read_or_none()
        return rows if rows is not None else self.spark.createDataFrame([], LEDGER_SCHEMA)

    def raw_staged(self) -> TableStore:
        """table_name, version: up to which version the rows of a raw table have reached staging."""
        return self._store("meta/raw_staged")

    def is_staged(self, table_name: str) -> bool:
        """Whether the raw table, as far as the ledger confirms it, has nothing that staging lacks."""
        newest = self.raw(table_name).current(self.ledger_rows())
        rows = self.raw_staged().read_or_none()
        noted = None if rows is None else rows.filter(F.col("table_name") == table_name).agg(F.max("version")).first()[0]
        return newest is None or (noted is not None and noted >= newest.version)

    def note_staged(self, table_name: str, version: int, run_id: str) -> None:
        rows = self.spark.createDataFrame([(table_name, version)], "table_name string, version bigint")
        self.raw_staged().upsert(rows, "table_name", f"{run_id}-{table_name}-{version}")

    def passed_versions(self, source: str) -> dict[str, int]:
        """Layer -> the version that last passed all checks of a whole build."""
        rows = self._store(f"meta/{source}_passed").read_or_none()
        return {} if rows is None else {r["layer"]: r["version"] for r in rows.collect()}

    def note_passed(self, source: str, versions: dict[str, int], run_id: str) -> None:
        rows = self.spark.createDataFrame(list(versions.items()), "layer string, version bigint").coalesce(1)
        self._store(f"meta/{source}_passed").overwrite(rows, run_id)
