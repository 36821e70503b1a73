"""Removal of repeated substrings by suffix arrays of shards.

A byte goes if it is covered by a string of `length` bytes that also starts somewhere else. To spare the
suffix arrays what cannot repeat, every window of that length is first named by its anchor, the 32-byte piece
with the least hash inside it: equal windows have equal anchors. Neighbouring windows with one anchor form a
context. Anchors seen once cannot repeat, contexts seen twice repeat as a whole, and only different contexts
of one anchor need a closer look. These are dealt over shards by anchor (a frequent anchor over several), and each
shard sorts their suffixes. Windows of anchors that were split are matched across shards by binary
search in the merged order of the shards' window names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom.llm.buffers import U64, as_long, chunks, mix, powers, prefix_sums, span_hashes, text_bytes
from stateloom.llm.shared import passing, settled
from stateloom.llm.suffixes import common_prefixes, suffix_array

LENGTH = 200
ANCHOR = 32
SHARD_CONTEXTS = 1024  # contexts of one anchor in one shard
SHARD_BYTES = 1 << 20
SEGMENT_BYTES = 16 << 20  # longer texts are read in overlapping segments
PLACE_BITS = U64(26)

# place: the first window's start, and in the last 16 bits the number of windows
CONTEXTS = "doc long, text_hash long, anchor long, context long, place long"
SPANS = "doc long, text_hash long, spans array<struct<a: int, b: int>>"
SPANS_ARROW = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each run of `width`, by running minima from both ends of blocks."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, U64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, 1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def contexts_of(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """row, anchor hash, context hash, first window's start in the row, and number of windows of every context."""
    sizes = np.diff(offsets) - length + 1
    if not (sizes > 0).any():
        none = np.empty(0, np.int64)
        return none, none.astype(U64), none.astype(U64), none, none
    sums = prefix_sums(data)
    n = len(data) - anchor + 1
    pieces = mix((sums[anchor:] - sums[:n]) * powers(len(sums))[1][:n])
    keys = (pieces & ~((U64(1) << PLACE_BITS) - U64(1))) | np.arange(n, dtype=U64)
    least = window_minima(keys, length - anchor + 1)
    rows = np.flatnonzero(sizes > 0)
    starts = np.concatenate([np.arange(offsets[r], offsets[r] + sizes[r]) for r in rows])
    row = np.repeat(rows, sizes[rows])
    place = (least[starts] & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
    lead = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
    count = np.diff(np.append(lead, len(starts)))
    first = starts[lead]
    return row[lead], pieces[place[lead]], span_hashes(sums, first, first + count - 1 + length), first - offsets[row[lead]], count


def contexts(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """All contexts of (doc, text_hash, text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, data, offsets in chunks(batch.column(2)):
                step = SEGMENT_BYTES
                for at in range(0, max(1, len(data) - length + 1), step):
                    # a chunk of several rows is far below a segment: only a single long row has more than one
                    part = data if len(data) <= step else data[at : at + step + length - 1]
                    bounds = offsets if len(data) <= step else np.array([0, len(part)])
                    row, piece, context, start, count = contexts_of(part, bounds, length, anchor)
                    at_rows = pa.array(row + lo)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at_rows), batch.column(1).take(at_rows), pa.array(piece.view(np.int64)), pa.array(context.view(np.int64)),
                         pa.array(((start + at) << 16) | count)],
                        names=["doc", "text_hash", "anchor", "context", "place"],
                    )
                    if len(data) <= step:
                        break

    return texts.mapInArrow(find, CONTEXTS)


def runs(mask: np.ndarray) -> np.ndarray:
    """Start and end of each run of True."""
    return np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))).reshape(-1, 2)


SHARD_OUT = f"{SPANS}, anchor long, bucket int, names array<struct<x: long, y: long, doc: long, text_hash: long, at: int>>"
NAMES_ARROW = pa.list_(pa.struct([("x", pa.int64()), ("y", pa.int64()), ("doc", pa.int64()), ("text_hash", pa.int64()), ("at", pa.int32())]))
SHARD_ARROW = pa.schema(
    [("doc", pa.int64()), ("text_hash", pa.int64()), ("spans", SPANS_ARROW), ("anchor", pa.int64()), ("bucket", pa.int32()), ("names", NAMES_ARROW)]
)


def search_shards(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, salt, salts, doc, text_hash, start, windows, bytes), sorted by anchor and salt, to spans that repeat.

    One row per context, with its spans; and for anchors over several shards one row per bucket of window names,
    which says of each distinct window (its 128-bit name) where one of its places is.
    """
    waiting: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, salt = (batch.column(c).to_numpy() for c in ("anchor", "salt"))
        new = np.concatenate([[(anchor[0], salt[0]) != last], (anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])])
        last = (anchor[-1], salt[-1])
        before = text_bytes(batch.column("bytes"))[1]
        lo = 0
        for k in np.flatnonzero(new).tolist():
            if size + before[k] - before[lo] >= SHARD_BYTES:
                yield search_shard(pa.Table.from_batches([*waiting, batch.slice(lo, k - lo)]), length)
                waiting, size, lo = [], 0, k
        waiting.append(batch.slice(lo))
        size += int(before[-1] - before[lo])
    if waiting:
        yield search_shard(pa.Table.from_batches(waiting), length)


def search_shard(rows: pa.Table, length: int) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    text, begin = text_bytes(rows.column("bytes"))
    count, first, anchor, salts = (rows.column(c).to_numpy().astype(np.int64) for c in ("windows", "start", "anchor", "salts"))
    order, rank = suffix_array(text)
    shared = common_prefixes(text, order, rank)
    # in the order of suffixes, equal windows stand together: between them, all share `length` bytes
    group = np.cumsum(shared < length)
    which = np.repeat(np.arange(len(count)), count)
    within = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    starts = begin[which] + within
    own = group[rank[starts]]
    times = np.bincount(own, minlength=len(text) + 1)
    repeated = times[own] > 1
    # runs of repeated windows, none across rows
    edge = within == 0
    head = np.flatnonzero(repeated & (edge | ~np.concatenate([[False], repeated[:-1]])))
    tail = np.flatnonzero(repeated & np.concatenate([edge[1:] | ~repeated[1:], [True]]))
    with_spans, at = np.unique(which[head], return_index=True)
    spans = pa.StructArray.from_arrays(
        [pa.array((within[place] + first[which[place]] + more).astype(np.int32)) for place, more in ((head, 0), (tail, length))], names=["a", "b"]
    )
    found = rows.select(["doc", "text_hash"]).take(pa.array(with_spans))
    found = found.append_column("spans", pa.ListArray.from_arrays(np.append(at, len(head)).astype(np.int32), spans))
    split = (salts > 1)[which]
    names = pa.table({"anchor": pa.array([], pa.int64()), "bucket": pa.array([], pa.int32()), "names": pa.array([], NAMES_ARROW)})
    if split.any():
        sums, high = prefix_sums(text), prefix_sums(np.roll(text, 1) ^ np.uint8(0x5A))
        picked = np.flatnonzero(split)
        # one place of each distinct window
        _, one = np.unique(own[picked], return_index=True)
        picked = picked[one]
        at, row = starts[picked], which[picked]
        x = span_hashes(sums, at, at + length)
        y = span_hashes(high, at + 1, at + length)
        bucket = (x % salts[row].astype(U64)).astype(np.int64)
        again = np.lexsort((y, x, bucket, anchor[row]))
        picked, row, x, y, bucket = picked[again], row[again], x[again], y[again], bucket[again]
        lead = np.flatnonzero(np.concatenate([[True], (np.diff(anchor[row]) != 0) | (np.diff(bucket) != 0)]))
        doc, text_hash = (rows.column(c).take(pa.array(row)).combine_chunks() for c in ("doc", "text_hash"))
        each = [as_long(x), as_long(y), doc, text_hash, pa.array((within[picked] + first[row]).astype(np.int32))]
        each = pa.StructArray.from_arrays(each, names=["x", "y", "doc", "text_hash", "at"])
        lists = pa.ListArray.from_arrays(np.append(lead, len(row)).astype(np.int32), each)
        names = pa.table({"anchor": anchor[row[lead]], "bucket": bucket[lead].astype(np.int32), "names": lists})
    out = pa.concat_tables([found, names], promote_options="default").select(["doc", "text_hash", "spans", "anchor", "bucket", "names"])
    return out.combine_chunks().cast(SHARD_ARROW).to_batches()[0] if out.num_rows else pa.RecordBatch.from_pylist([], SHARD_ARROW)


def merge_shards(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(anchor, bucket, lists of names) to the spans of windows that occur in two shards or more."""
    for batch in batches:
        for lists in batch.column(2):
            names = [pa.array(part["names"].as_py(), NAMES_ARROW.value_type) for part in lists]
            parts = [np.rec.fromarrays([part.field(0).to_numpy(), part.field(1).to_numpy()], names="x,y") for part in names]
            merged = np.sort(np.concatenate(parts), order=["x", "y"])
            docs, hashes, spans = [], [], []
            for part, own in zip(parts, names, strict=True):
                elsewhere = np.searchsorted(merged, part, "right") - np.searchsorted(merged, part, "left") > 1
                for row in own.filter(pa.array(elsewhere)).to_pylist():
                    docs.append(row["doc"])
                    hashes.append(row["text_hash"])
                    spans.append([{"a": row["at"], "b": row["at"] + length}])
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(hashes, pa.int64()), pa.array(spans, SPANS_ARROW)], names=["doc", "text_hash", "spans"])


RESULT = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"


def cut(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    """(doc, bytes, spans) to what is left."""
    for batch in batches:
        columns: list[list] = [[], [], [], [], []]
        for k in range(batch.num_rows):
            value = batch.column(1)[k]
            data = np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else np.empty(0, np.uint8)
            spans = batch.column(2)[k].values
            removed = np.zeros(len(data) + 1, np.int64)
            if spans is not None:
                np.add.at(removed, spans.field(0).to_numpy(), 1)
                np.add.at(removed, spans.field(1).to_numpy(), -1)
            gone = np.cumsum(removed[:-1]) > 0
            rest = data[~gone].tobytes()
            for c, v in enumerate((len(data), int(gone.sum()), len(runs(gone)), hashlib.sha256(rest).hexdigest(), rest if with_text else None)):
                columns[c].append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, t) for v, t in zip(columns, kinds, strict=True)]], names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def remove_repeats(
    documents: DataFrame, doc: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR,
    shard_contexts: int = SHARD_CONTEXTS, with_text: bool = True,
) -> DataFrame:
    """doc, n_bytes, n_removed, n_spans, kept_sha256 and kept_text (bytes; a cut may fall inside a character), per row.

    Matches never cross documents, and are judged on the input. A null text is empty; texts below `length` bytes stay
    whole; repeated rows repeat each other, so that they lose every byte of a text of `length` or more.
    """
    texts = documents.select(F.col(doc).cast("long").alias("doc"), F.xxhash64(text).alias("text_hash"), F.encode(text, "UTF-8").alias("bytes"))
    # shuffle files go with the step that wrote them, tables with their last reader: waiting for the collector filled the disk
    every = passing(contexts(texts, length, anchor), "contexts")
    # counts by a key are written before they meet that key's rows: only then can a hot key's side be split
    often = passing(every.rows.groupBy("anchor").agg(F.count("*").alias("times")).filter("times > 1").select("anchor"), "anchors-again")
    again = passing(every.rows.join(often.rows, "anchor"), "contexts-again")
    every.drop()
    often.drop()
    seen = again.rows
    where = F.struct(F.col("doc").isNull(), "doc", "text_hash", "place")
    start, windows = F.shiftright("place", 16).cast("int").alias("start"), F.col("place").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("windows")
    each = passing(seen.groupBy("anchor", "context").agg(F.count("*").alias("times"), F.min(where).alias("one")), "contexts-each")
    several = passing(each.rows.groupBy("anchor").agg(F.count("*").alias("contexts")).filter("contexts > 1"), "anchors-several")
    # whole contexts that repeat
    whole = seen.join(each.rows.filter("times > 1").select("anchor", "context"), ["anchor", "context"]).select(
        "doc", "text_hash", F.struct(start.alias("a"), (start + windows - 1 + length).alias("b")).alias("span")
    )
    # one place of each context whose anchor has others
    looked = each.rows.join(several.rows, "anchor").select("anchor", "context", "contexts", "one").join(seen, ["anchor", "context"])
    looked = looked.filter(where == F.col("one")).select(
        "doc", "text_hash", F.struct("anchor", "context", "contexts", start, windows).alias("look")
    )
    nothing = "array<struct<a: int, b: int>>", "array<struct<anchor: long, context: long, contexts: long, start: int, windows: int>>"
    per_text = whole.select("doc", "text_hash", "span", F.lit(None).cast(looked.schema["look"].dataType).alias("look")).unionByName(
        looked.select("doc", "text_hash", F.lit(None).cast(whole.schema["span"].dataType).alias("span"), "look")
    )
    per_text = per_text.groupBy("doc", "text_hash").agg(F.collect_list("span").alias("spans"), F.collect_list("look").alias("looks"))
    found = passing(per_text.select(F.col("doc").alias("d"), F.col("text_hash").alias("h"), "spans", "looks"), "texts-found")
    for table in (again, each, several):
        table.drop()
    joined = texts.join(found.rows, F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    # only texts with repeats are carried on
    empty = F.coalesce("bytes", F.lit(b""))
    clean = F.col("h").isNull()
    held = settled(joined.select(
        "doc", "text_hash", clean.alias("clean"), F.octet_length(empty).cast("long").alias("n_bytes"), F.sha2(empty, 256).alias("sha"),
        (empty if with_text else F.when(~clean, empty)).alias("bytes"), F.coalesce("spans", F.array().cast(nothing[0])).alias("spans"),
        F.coalesce("looks", F.array().cast(nothing[1])).alias("looks"),
    ), "texts-again")
    found.drop()
    shards = held.filter(F.size("looks") > 0).select("doc", "text_hash", "bytes", F.explode("looks").alias("look")).select(
        "look.anchor", F.ceil(F.col("look.contexts") / shard_contexts).alias("salts"), "look.context", "doc", "text_hash", "look.start", "look.windows",
        F.substring("bytes", F.col("look.start") + 1, F.col("look.windows") - 1 + length).alias("bytes"),
    )
    shards = shards.withColumn("salt", F.pmod("context", "salts")).select("anchor", "salt", "salts", "doc", "text_hash", "start", "windows", "bytes")
    dealt = shards.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
    sorted_ = settled(dealt.mapInArrow(lambda b: search_shards(b, length), SHARD_OUT), "shards")
    lists = sorted_.filter("names is not null").groupBy("anchor", "bucket").agg(F.collect_list(F.struct("names")).alias("lists"))
    across = lists.mapInArrow(lambda b: merge_shards(b, length), SPANS)
    more = sorted_.filter("spans is not null").select("doc", "text_hash", "spans").unionByName(across)
    more = more.groupBy(F.col("doc").alias("d"), F.col("text_hash").alias("h")).agg(F.flatten(F.collect_list("spans")).alias("more"))
    rest = held.filter(~F.col("clean")).join(more, F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    rest = rest.select("doc", "bytes", F.concat("spans", F.coalesce("more", F.array().cast(nothing[0]))).alias("spans"))
    whole_texts = held.filter("clean").select(
        "doc", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"), F.col("bytes").alias("kept_text")
    )
    return rest.mapInArrow(lambda b: cut(b, with_text), RESULT).unionByName(whole_texts)
