"""Repeated word windows between documents by relative Lempel-Ziv factors.

A window is `window` consecutive words of one document. A word goes if a window over it also starts in a
document with a smaller id; windows are judged on the texts as they came in.

Factoring every document against every block of all texts would grow with the square of the corpus.
Blocks are dealt by content instead, so that a window meets the one block that can hold its equals: each
window names an anchor, its least-hashed run of `anchor` words (the first of equals), and neighbouring
windows with one anchor form a segment. Equal windows have equal anchors.

1. Documents are packed into chunks of bounded size, written once: a chunk and its rows keep their names.
2. Anchors that stand in documents with different ids are found from hashes alone (`repeated_anchors`). A hash
   shared by chance only brings a segment more.
3. The segments of those anchors go to the blocks as text (`segments`), equal ones of a chunk once, with the least and
   the greatest id that has them.
4. In a block the segments stand by id. Each is parsed into factors: the first copy of a window in the block is
   its reference, and a factor runs on while the reference does. Factors are compared with their reference byte
   by byte. The next factor starts with the first window that the last one does not hold, so windows
   across a factor's end are looked up like all others.
5. A chunk learns the least id of each window of its segments, and spans follow for each of its documents.

Frequent anchors (above `hot` places) are dealt window by window instead, so that their blocks hold copies of
one window, of which a chunk sends one: no block grows with the number of copies but by one row a chunk.

Null texts and texts without words have no words and lose none. Rows without an id lose nothing and take nothing
from others. Rows with one id are one document's rows: they take nothing from each other. An empty table gives
an empty result. Only id and text are read, whatever other columns are called; ids are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stateloom.llm.buffers import U64, chunks, mix, powers, prefix_sums, span_hashes, text_bytes, word_spans
from stateloom.llm.shared import settled

BLANKS = [32, 9, 10, 11, 12, 13]
CHUNK = 4 << 20  # bytes of text, or one longer document
BLOCK = 4 << 20  # bytes of segments parsed at once; a key's segments stay together
NO_ID = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Options:
    window: int = 13
    anchor: int = 7
    hot: int = 5_000

    def __post_init__(self):
        if not 0 < self.anchor <= self.window or self.hot < 1:
            raise ValueError("anchor must be from 1 to window, hot at least 1")


def word_table() -> np.ndarray:
    inside = np.ones(256, bool)
    inside[BLANKS] = False
    return inside


IS_WORD = word_table()
BLANKED = np.where(IS_WORD, np.arange(256), 32).astype(np.uint8)


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


class Words:
    """The words of some rows of text, with one blank between those of a row, and their hashes."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        starts, ends, self.first = word_spans(data, offsets, IS_WORD)
        sizes = ends - starts
        self.n = len(starts)
        take = IS_WORD[data]
        filled = np.flatnonzero(np.diff(self.first))
        open_ended = self.first[1:][filled] - 1  # a row's last word has no blank behind it
        self.spaced = np.ones(self.n, np.int64)
        self.spaced[open_ended] = 0
        take[ends[self.spaced > 0]] = True
        self.data = BLANKED[data[take]]
        self.starts = np.cumsum(sizes + self.spaced) - sizes - self.spaced
        self.ends = self.starts + sizes
        self.row = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        self.hashes = span_hashes(prefix_sums(self.data), self.starts, self.ends)

    def runs(self, size: int) -> np.ndarray:
        """A hash for each run of `size` words, by its first; rows are not told apart."""
        if self.n < size:
            return np.empty(0, U64)
        up, down = powers(self.n + 1)
        sums = np.zeros(self.n + 1, U64)
        np.cumsum(self.hashes * up[: self.n], out=sums[1:])
        return mix((sums[size:] - sums[:-size]) * down[: self.n - size + 1] + U64(size))

    def whole(self, size: int) -> np.ndarray:
        """Which words start a run of `size` words inside one row."""
        return np.arange(self.n) + size <= self.first[1:][self.row]


def places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of spans, one span after the other."""
    if not len(sizes):
        return np.empty(0, np.int64)
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def anchored(words: Words, options: Options) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments: first window, number of windows, and anchor hash."""
    whole = words.whole(options.window)
    start = np.flatnonzero(whole)
    if not len(start):
        return start, start, np.empty(0, np.int64)
    grams, many = words.runs(options.anchor), words.n - options.window + 1
    least, at = grams[:many].copy(), np.arange(many)
    for step in range(1, options.window - options.anchor + 1):
        other = grams[step : step + many]
        smaller = other < least
        np.minimum(least, other, out=least)
        at[smaller] = np.flatnonzero(smaller) + step
    least, at = least[whole[:many]], at[whole[:many]]
    # one place of an anchor lies in one row: windows that share it follow one another
    heads = np.flatnonzero(np.diff(at, prepend=-1) != 0)
    return start[heads], np.diff(np.append(heads, len(start))), least[heads].view(np.int64)


def ids_of(rows: pa.Table) -> np.ndarray:
    """Ids as long; NO_ID where there is none."""
    return rows.column("id").combine_chunks().fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)


def pack_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, count = TaskContext.get().partitionId(), 0
    for batch in batches:
        for lo, hi, _, _ in chunks(batch.column("text"), CHUNK, 1 << 30):
            rows = pa.Table.from_batches([batch.slice(lo, hi - lo)])
            yield pa.RecordBatch.from_arrays([pa.array([task << 32 | count]), pa.array([packed(rows)], pa.binary())], names=["chunk", "rows"])
            count += 1


def judged_segments(words: Words, ids: np.ndarray, options: Options):
    """Segments of rows with an id: first window, number of windows, anchor, id."""
    first, n, anchor = anchored(words, options)
    own = ids[words.row[first]] if len(first) else np.empty(0, np.int64)
    known = own != NO_ID
    return first[known], n[known], anchor[known], own[known]


def find_anchors(options: Options):
    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("rows")):
                rows = unpacked(blob.as_py())
                _, n, anchor, own = judged_segments(Words(rows.column("text")), ids_of(rows), options)
                order = np.argsort(anchor, kind="stable")
                heads = np.flatnonzero(np.diff(anchor[order], prepend=~anchor[order[0]]) != 0) if len(order) else order
                if not len(heads):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[order][heads]),
                        pa.array(np.full(len(heads), chunk)),
                        pa.array(np.minimum.reduceat(own[order], heads)),
                        pa.array(np.maximum.reduceat(own[order], heads)),
                        pa.array(np.diff(np.append(heads, len(order)))),
                    ],
                    names=["anchor", "chunk", "lo", "hi", "n"],
                )

    return run


def repeated_anchors(packs: DataFrame, options: Options) -> DataFrame:
    """(chunk, anchor, places): for each chunk its anchors that stand in documents with different ids.

    An anchor is one row a chunk, so the frequent ones are no hot keys.
    """
    found = packs.mapInArrow(find_anchors(options), "anchor long, chunk long, lo long, hi long, n long")
    of = Window.partitionBy("anchor")
    spread = found.select("chunk", "anchor", F.min("lo").over(of).alias("lo"), F.max("hi").over(of).alias("hi"), F.sum("n").over(of).alias("places"))
    return spread.filter("lo < hi").select("chunk", "anchor", "places")


SEGMENTS = "places boolean, chunk long, key long, u int, text binary, lo long, hi long"


def cut_segments(options: Options):
    """A chunk and its repeated anchors to its distinct segments, and one row that says where they stand."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema(
            [("places", pa.bool_()), ("chunk", pa.int64()), ("key", pa.int64()), ("u", pa.int32()), ("text", pa.binary()), ("lo", pa.int64()), ("hi", pa.int64())]
        )
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        chunk, rows = left.column("chunk")[0].as_py(), unpacked(left.column("rows")[0].as_py())
        words = Words(rows.column("text"))
        first, n, anchor, own = judged_segments(words, ids_of(rows), options)
        wanted, count = (right.column(c).combine_chunks().to_numpy() for c in ("anchor", "places"))
        order = np.argsort(wanted)
        at = np.minimum(np.searchsorted(wanted, anchor, sorter=order), len(wanted) - 1)
        named = wanted[order][at] == anchor
        first, n, anchor, own, frequent = first[named], n[named], anchor[named], own[named], (count[order][at] > options.hot)[named]
        if not len(first):
            return schema.empty_table()
        # windows of frequent anchors are segments of their own, and their own hash is the key
        single = places(first[frequent], n[frequent])
        key = np.concatenate([anchor[~frequent], words.runs(options.window).view(np.int64)[single]])
        first, n, own = (
            np.concatenate([first[~frequent], single]), np.concatenate([n[~frequent], np.ones(len(single), np.int64)]),
            np.concatenate([own[~frequent], np.repeat(own[frequent], n[frequent])]),
        )
        begin, end = words.starts[first], words.ends[first + n + options.window - 2]
        cuts = np.concatenate([[0], np.cumsum(end - begin)])
        data = pa.py_buffer(words.data[places(begin, end - begin)])
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(cuts.astype(np.int64)), data]).dictionary_encode()
        u = texts.indices.to_numpy()
        distinct = len(texts.dictionary)
        lo, hi, keys = np.full(distinct, np.iinfo(np.int64).max), np.full(distinct, NO_ID), np.empty(distinct, np.int64)
        np.minimum.at(lo, u, own)
        np.maximum.at(hi, u, own)
        keys[u] = key
        where = packed(pa.table({"first": first, "n": n.astype(np.int32), "u": u, "own": own}))
        return pa.concat_tables(
            [
                pa.table(
                    [
                        pa.array(np.zeros(distinct, bool)), pa.array(np.full(distinct, chunk)), pa.array(keys), pa.array(np.arange(distinct, dtype=np.int32)),
                        texts.dictionary.cast(pa.binary()), pa.array(lo), pa.array(hi),
                    ],
                    schema=schema,
                ),
                pa.Table.from_pylist([{"places": True, "chunk": chunk, "text": where}], schema=schema),
            ]
        )

    return run


def first_windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that start a window, and for each the first one with an equal window.

    Windows are paired by hash, parsed into factors, and factors compared with their references as bytes.
    """
    start = np.flatnonzero(words.whole(window))
    hashes = words.runs(window)[start] if len(start) else np.empty(0, U64)
    order = np.argsort(hashes, kind="stable")
    head = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]][0]) != 0) if len(order) else order
    reference = np.empty_like(start)
    reference[order] = np.repeat(start[order[head]], np.diff(np.append(head, len(order))))
    # a factor: windows that follow one another, in text and reference
    begins = np.flatnonzero((np.diff(start, prepend=-9) != 1) | (np.diff(reference, prepend=-9) != 1))
    windows = np.diff(np.append(begins, len(start)))
    copied = reference[begins] != start[begins]
    begins, windows = begins[copied], windows[copied]
    here, there = start[begins], reference[begins]
    size = words.ends[here + windows + window - 2] - words.starts[here]
    same = size == words.ends[there + windows + window - 2] - words.starts[there]
    if same.all():
        same = words.data[places(words.starts[here], size)] == words.data[places(words.starts[there], size)]
    if not same.all():  # two windows share a hash: tell them apart by their bytes
        text, seen = words.data.tobytes(), {}
        for i, s in enumerate(start.tolist()):
            reference[i] = seen.setdefault(text[words.starts[s] : words.ends[s + window - 1]], s)
    return start, reference


def parse_blocks(options: Options):
    """Segments ordered by key and id to the least id of each of their windows, where that is smaller than an id of theirs."""

    def parse(block: pa.Table) -> pa.RecordBatch:
        words = Words(block.column("text"))
        start, reference = first_windows(words, options.window)
        lo, hi = (block.column(c).combine_chunks().to_numpy() for c in ("lo", "hi"))
        least, row = lo[words.row[reference]], words.row[start]
        cuts = np.searchsorted(row, np.arange(block.num_rows + 1))
        told = np.zeros(block.num_rows, bool)
        told[row[least < hi[row]]] = True
        take = np.flatnonzero(told)
        sizes = np.diff(cuts)[take]
        lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), least[places(cuts[take], sizes)])
        picked = block.take(pa.array(take))
        return pa.RecordBatch.from_arrays(
            [picked.column("chunk").combine_chunks(), picked.column("u").combine_chunks(), lists], names=["chunk", "u", "least"]
        )

    def run(batches):
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            size += batch.nbytes
            if size < BLOCK:
                continue
            table = pa.Table.from_batches(waiting)
            keys = table.column("key").to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
            if whole:
                yield parse(table.slice(0, whole).combine_chunks())
            rest = table.slice(whole).combine_chunks()
            waiting, size = rest.to_batches(), rest.nbytes
        if waiting:
            yield parse(pa.Table.from_batches(waiting).combine_chunks())

    return run


def left_over(words: Words, removed: np.ndarray) -> list[bytes]:
    """Each row's words that are not removed, joined by one blank."""
    take = np.ones(len(words.data), bool)
    gone = np.flatnonzero(removed)
    take[places(words.starts[gone], words.ends[gone] - words.starts[gone] + words.spaced[gone])] = False
    kept = np.concatenate([[0], np.cumsum(take)])
    data, cuts = words.data[take].tobytes(), kept[np.append(words.starts, len(words.data))[words.first]].tolist()
    return [data[a:b].removesuffix(b" ") for a, b in zip(cuts, cuts[1:])]


def cleaned(options: Options, kind: pa.DataType, with_text: bool):
    """A chunk, the places of its segments and what was found for them to its documents without repeated words."""
    schema = pa.schema(
        [("id", kind), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), *([("kept", pa.string())] if with_text else [])]
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blobs = {p: b for p, b in zip(left.column("places").to_pylist(), left.column("rows").to_pylist())}
        rows = unpacked(blobs[False])
        words = Words(rows.column("text"))
        cover = np.zeros(words.n + 1, np.int64)
        if right.num_rows:
            where = unpacked(blobs[True])
            first, n, u, own = (where.column(c).combine_chunks().to_numpy() for c in ("first", "n", "u", "own"))
            lists = right.column("least").combine_chunks()
            offsets, values = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
            of = np.full(int(u.max()) + 1, -1, np.int64)
            of[right.column("u").combine_chunks().to_numpy()] = np.arange(right.num_rows)
            told = of[u] >= 0
            first, n, u, own = first[told], n[told].astype(np.int64), u[told], own[told]
            gone = places(first, n)[values[places(offsets[of[u]], n)] < np.repeat(own, n)]
            cover[: words.n] += np.bincount(gone, minlength=words.n)[: words.n]
            cover -= np.bincount(gone + options.window, minlength=words.n + 1)
        removed = np.cumsum(cover)[:-1] > 0
        texts = left_over(words, removed)
        counted = np.concatenate([[0], np.cumsum(removed)])
        columns = [
            rows.column("id").combine_chunks(), pa.array(np.diff(words.first)), pa.array(np.diff(counted[words.first])),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts]), *([pa.array(texts, pa.binary()).cast(pa.string())] if with_text else []),
        ]
        return pa.table(columns, schema=schema)

    return run


def remove_repeated_windows(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", options: Options = Options(), with_text: bool = True
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256[, kept]) for each row; `kept` joins the words left by one blank."""
    rows = documents.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError(f"ids must be whole numbers, not {kind}")
    packs = settled(rows.mapInArrow(pack_chunks, "chunk long, rows binary"), "chunks")
    anchors = settled(repeated_anchors(packs, options), "anchors")
    parts = settled(packs.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(cut_segments(options), SEGMENTS), "segments", "places")
    # the reference of a window is the first of its block: the one with the least id
    ordered = parts.filter("not places").select("key", "lo", "hi", "chunk", "u", "text").repartition("key").sortWithinPartitions("key", "lo", "chunk", "u")
    found = settled(ordered.mapInArrow(parse_blocks(options), "chunk long, u int, least array<long>"), "found")
    left = packs.select("chunk", F.lit(False).alias("places"), "rows").unionByName(
        parts.filter("places").select("chunk", "places", F.col("text").alias("rows"))
    )
    arrow_kind = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[kind]
    out = f"id {kind}, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")
    return left.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(cleaned(options, arrow_kind, with_text), out)
