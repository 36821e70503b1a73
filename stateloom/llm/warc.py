"""WARC archives as seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each holding whole records, closed by a seek
table in a skippable frame: the public seekable format, which any Zstandard reader decompresses in
one go. An index table maps record ids to bundle, frame and the record's offset inside the frame.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.llm.shared import kept, scratch

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 128 << 20
WARC_DATE = "1970-01-01T00:00:00Z"
INDEX = "record_id string, page_id long, record_type string, bundle string, frame int, frame_offset long, length long"
READ = (
    "record_id string, page_id long, record_type string, url string, payload_digest string, payload_bytes long,"
    " refers_to_id string, payload binary"
)


def as_records(pages: DataFrame, min_revisit_bytes: int = 100) -> DataFrame:
    """One record per row of page_id, url, html: digest, type and, for revisits, the record referred to.

    Of rows with equal payloads of at least `min_revisit_bytes`, that with the smallest id (null ids last)
    is the response; a row repeated in full is a response each time. A null html is an empty payload.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    large = F.col("payload_bytes") >= min_revisit_bytes
    firsts = rows.filter(large).groupBy("payload_digest").agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "url")).alias("first"))
    firsts = firsts.select(F.col("payload_digest").alias("same_as"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    # small payloads get keys of their own, so that they spread and find nothing
    key = F.when(large, F.col("payload_digest")).otherwise(F.concat_ws(":", F.lit("small"), F.xxhash64("page_id", "url")))
    joined = rows.withColumn("same_as", key).join(firsts, "same_as", "left")
    revisit = large & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", "payload", "payload_digest", "payload_bytes", record_id("page_id", "url", "payload_digest").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, record_id("first_id", "first_url", "payload_digest")).alias("refers_to_id"),
    )


def record_id(*columns: str):
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def record_bytes(row: dict, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["payload_bytes"]
    block = http + (row["payload"] if row["record_type"] == "response" else b"")
    head = {
        "WARC-Type": row["record_type"], "WARC-Record-ID": f"<{row['record_id']}>", "WARC-Date": date,
        "WARC-Target-URI": row["url"] and row["url"].replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Page-ID": row["page_id"], "WARC-Payload-Digest": f"sha256:{row['payload_digest']}",
        "Content-Type": "application/http; msgtype=response",
    }
    if row["record_type"] == "revisit":
        head |= {"WARC-Refers-To": f"<{row['refers_to_id']}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    head["Content-Length"] = len(block)
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


class Bundle:
    """One archive file being written: frames, then the seek table."""

    def __init__(self, folder: str, level: int):
        self.store, path = pafs.FileSystem.from_uri(folder)
        self.store.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out, self.level = self.store.open_output_stream(f"{path}/{self.name}", compression=None), level
        self.sizes: list[tuple[int, int]] = []

    def add(self, records: bytes) -> int:
        packed = zstandard.ZstdCompressor(level=self.level).compress(records)
        self.out.write(packed)
        self.sizes.append((len(packed), len(records)))
        return len(self.sizes) - 1

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *pair) for pair in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


def write_bundles(
    records: DataFrame, folder: str | None = None, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
    level: int = 3, date: str = WARC_DATE,
) -> tuple[str, DataFrame]:
    """Write the records into bundles below `folder`; returns it and the index of records.

    Each task writes files of its own under new names. The index, committed by Spark, names only the
    files of tasks that ended well: what a lost executor left behind is in no index and never read.
    """
    folder = folder or scratch(records.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, frame, size, waiting, written = None, [], 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal bundle, frame, size, waiting, written
            bundle = bundle or Bundle(folder, level)
            number = bundle.add(b"".join(frame))
            written += bundle.sizes[-1][0]
            rows = [r | {"bundle": bundle.name, "frame": number} for r in waiting]
            frame, size, waiting = [], 0, []
            if written >= bundle_bytes:
                bundle.close()
                bundle, written = None, 0
            yield pa.RecordBatch.from_pylist(rows, schema=INDEX_ARROW)

        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(k)[at].as_py() for k, name in enumerate(batch.schema.names)}
                record = record_bytes(row, date)
                waiting.append(
                    {k: row[k] for k in ("record_id", "page_id", "record_type")} | {"frame_offset": size, "length": len(record)}
                )
                frame.append(record)
                size += len(record)
                if size >= frame_bytes:
                    yield from flush()
        if frame:
            yield from flush()
        if bundle:
            bundle.close()

    return folder, kept(records.mapInArrow(write, INDEX), "warc-index")


INDEX_ARROW = pa.schema(
    [("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("bundle", pa.string()),
     ("frame", pa.int32()), ("frame_offset", pa.int64()), ("length", pa.int64())]
)
READ_ARROW = pa.schema(
    [("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()),
     ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to_id", pa.string()), ("payload", pa.binary())]
)


def seek_table(source: pa.NativeFile) -> list[tuple[int, int]]:
    """Start and packed size of each frame, from the end of the file."""
    end = source.size()
    source.seek(end - 9)
    count, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8
    source.seek(end - 9 - count * width)
    table, at, frames = source.read(count * width), 0, []
    for k in range(count):
        packed = struct.unpack_from("<I", table, k * width)[0]
        frames.append((at, packed))
        at += packed
    return frames


def parse_record(record: bytes, with_payload: bool) -> dict:
    """Fields of one record; the digest of a response is taken from its payload and must match the header."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    response = fields["WARC-Type"] == "response"
    if response and hashlib.sha256(payload).hexdigest() != stated:
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    page = fields.get("WARC-Page-ID")
    return {
        "record_id": fields["WARC-Record-ID"].strip("<>"), "page_id": page and int(page), "record_type": fields["WARC-Type"],
        "url": fields.get("WARC-Target-URI"), "payload_digest": stated, "payload_bytes": len(payload) if response else None,
        "refers_to_id": fields["WARC-Refers-To"].strip("<>") if "WARC-Refers-To" in fields else None,
        "payload": payload if response and with_payload else None,
    }


def read_records(spark: SparkSession, folder: str, index: DataFrame, with_payload: bool = True, frames_per_task: int = 16) -> DataFrame:
    """The records that `index` lists (all of it, or any rows), by seeking to their frames.

    A frame is fetched and unpacked once for all its listed records; frames are dealt over tasks.
    """
    places = index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list(F.struct("frame_offset", "length"))).alias("places"))
    tasks = max(1, -(-index.select("bundle", "frame").distinct().count() // frames_per_task))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(folder)
        name, source, frames = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bundle"] != name:
                    if source:
                        source.close()
                    name = row["bundle"]
                    source = store.open_input_file(f"{path}/{name}")
                    frames = seek_table(source)
                at, size = frames[row["frame"]]
                source.seek(at)
                records = zstandard.ZstdDecompressor().decompress(source.read(size))
                found = [parse_record(records[p["frame_offset"] : p["frame_offset"] + p["length"]], with_payload) for p in row["places"]]
                yield pa.RecordBatch.from_pylist(found, schema=READ_ARROW)
        if source:
            source.close()

    return places.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame").mapInArrow(read, READ)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """`records` with payload_bytes and refers_to (a page_id) of revisits taken from their responses."""
    targets = records.filter(F.col("record_type") == "response").groupBy(F.col("record_id").alias("refers_to_id"))
    targets = targets.agg(F.max("payload_bytes").alias("target_bytes"), F.min("page_id").alias("refers_to"))
    # responses refer to nothing: a key of their own each, so that they spread and find nothing
    key = F.coalesce("refers_to_id", F.concat(F.lit("-"), "record_id"))
    joined = records.withColumn("refers_to_id", key).join(targets, "refers_to_id", "left")
    return joined.select(
        "page_id", F.coalesce("payload_bytes", "target_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
