"""The latest copy of a table as CSV, replaced in two steps.

A publish writes a version folder that nobody reads yet, and then one small pointer that names it. Readers
take the newest pointer, so a publish that fails or is killed at any moment leaves the copy before it as it
was. Pointers are only ever added, each as one file, so no store has to replace a file in place. One publisher
at a time is assumed; of two that count alike, the greater folder name is read by all.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stateloom.operators.fingerprint import fold_md5
from stateloom.sources.files import find_files, with_digests

POINTER_SCHEMA = "version bigint, folder string, row_count bigint, md5 string, published_at string"


class Pointer(NamedTuple):
    version: int
    folder: str
    row_count: int
    md5: str
    published_at: str


def part_files(spark: SparkSession, folder: str) -> DataFrame:
    """The part files of a written folder with their digests and header lines."""
    return with_digests(find_files(spark, folder, "part-*").withColumnRenamed("length", "size"))


def folder_md5(spark: SparkSession, folder: str) -> str:
    """One checksum over a folder's part files, whatever their order."""
    return part_files(spark, folder).agg(fold_md5(F.col("md5")).alias("md5")).first()["md5"]


def write_csv(df: DataFrame, folder: str) -> None:
    """Values as they are: blanks around them stay."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)


class LatestCopy:
    """The copy below `path`: `versions/<run>-<attempt>/part-*` and `pointers/`."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def pointers(self) -> DataFrame:
        try:
            return self.spark.read.schema(POINTER_SCHEMA).json(f"{self.path}/pointers")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], POINTER_SCHEMA)

    def newest(self, count: int = 1) -> list[Pointer]:
        rows = self.pointers().orderBy(F.desc("version"), F.desc("folder")).limit(count).collect()
        return [Pointer(*row) for row in rows]

    def current(self) -> Pointer | None:
        return next(iter(self.newest()), None)

    def folder(self) -> str:
        """Where the latest copy lies now; later publishes leave that folder as it is."""
        pointer = self.current()
        if pointer is None:
            raise FileNotFoundError(f"nothing has been published at {self.path}")
        return f"{self.path}/{pointer.folder}"

    def read(self, schema: str | None = None) -> DataFrame:
        reader = self.spark.read.option("header", True).option("escape", '"').option("multiLine", True)
        return (reader.schema(schema) if schema else reader).csv(self.folder())

    def write(self, rows: DataFrame, run_id: str) -> Pointer:
        """The first step: a version folder of this attempt's own, with its count and checksum."""
        before = self.current()
        folder, seen = f"versions/{run_id}-{uuid.uuid4().hex}", Observation()
        write_csv(rows.observe(seen, F.count(F.lit(1)).alias("rows")), f"{self.path}/{folder}")
        md5 = folder_md5(self.spark, f"{self.path}/{folder}")
        stamp = dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds")
        return Pointer(before.version + 1 if before else 1, folder, seen.get["rows"], md5, stamp)

    def point(self, pointer: Pointer) -> None:
        """The second step, which makes a written version the latest copy."""
        self.spark.createDataFrame([pointer], POINTER_SCHEMA).coalesce(1).write.mode("append").json(f"{self.path}/pointers")

    def publish(self, rows: DataFrame, run_id: str) -> Pointer:
        pointer = self.write(rows, run_id)
        self.point(pointer)
        return pointer

    def version_folders(self) -> list[str]:
        """All version folders with files, those of failed publishes included."""
        name = F.regexp_extract("path", "/(versions/[^/]+)/[^/]+$", 1).alias("name")
        return sorted(r.name for r in find_files(self.spark, f"{self.path}/versions", "*").select(name).distinct().collect())

    def expired(self, keep: int = 2) -> list[str]:
        """Folders that none of the newest `keep` pointers names; not to be asked while a publish runs."""
        named = {p.folder for p in self.newest(keep)}
        return [f for f in self.version_folders() if f not in named]
