"""Benchmark decontamination: suffix arrays over the words of training shards, searched by benchmark suffixes.

A shard is a run of documents inside one task. Its words become 64-bit fingerprints; the suffixes
that can match at all (their first words begin a benchmark window) are sorted into a suffix array,
and every benchmark suffix is looked up there by binary search. The documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateloom.llm.buffers import LOWER, U64, chunks, mix, prefix_sums, span_hashes, word_spans
from stateloom.llm.shared import free_name

WINDOW = 10
LEAD = 4  # first words that a suffix must share with a benchmark window to enter the array
BLOCK_BYTES = 16 << 20  # benchmark text that one pass over the documents broadcasts

# [0-9a-z] and every byte of a character beyond ASCII, after A-Z were lowered
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words (never 0), and the first word of each row."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, WORD_BYTES)
    return np.maximum(span_hashes(prefix_sums(low), starts, ends), U64(1)), first


def lead_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Fingerprint of the first k columns."""
    out = words[:, 0].copy()
    for j in range(1, k):
        out = mix(out * U64(31) + words[:, j])
    return out


@dataclass
class Windows:
    """Distinct windows of one benchmark block, padded with 0, and where each occurs."""

    keys: np.ndarray  # n x WINDOW
    lengths: np.ndarray
    places: np.ndarray  # (window, item, word in item), by window
    first_place: np.ndarray
    items: list[str]
    item_words: np.ndarray
    item_first: np.ndarray
    lead: int
    maps: list[np.ndarray]  # by number of leading words: which top bits occur

    @staticmethod
    def of(rows: list) -> Windows:
        ids = ["" if r[0] is None else str(r[0]) for r in rows]
        names = {name: k for k, name in enumerate(dict.fromkeys(ids))}
        texts = pa.array([r[1] for r in rows], pa.large_string())
        parts, bounds = [], [0]
        for _, _, data, offsets in chunks(texts):
            words, first = words_of(data, offsets)
            parts.append(words)
            bounds += (bounds[-1] + first[1:]).tolist()
        words = np.concatenate(parts) if parts else np.empty(0, U64)
        keys, places = [], []
        for k, name in enumerate(ids):
            own = words[bounds[k] : bounds[k + 1]]
            size = min(WINDOW, len(own))
            if size:
                view = np.lib.stride_tricks.sliding_window_view(own, size)
                keys.append(np.pad(view, ((0, 0), (0, WINDOW - size))))
                places.append(np.stack([np.full(len(view), names[name]), np.full(len(view), k), np.arange(len(view))], 1))
        keys = np.concatenate(keys) if keys else np.empty((0, WINDOW), U64)
        places = np.concatenate(places) if places else np.empty((0, 3), np.int64)
        distinct, which = np.unique(keys, axis=0, return_inverse=True)
        order = np.argsort(which, kind="stable")
        lengths = (distinct != 0).sum(1)
        lead = int(min(LEAD, lengths.min(initial=LEAD)))
        maps = []
        for k in range(1, lead + 1):
            seen = np.zeros(1 << 20, bool)
            seen[lead_hashes(distinct, k) >> U64(44)] = True
            maps.append(seen)
        return Windows(
            distinct, lengths, places[order], np.searchsorted(which[order], np.arange(len(distinct) + 1)), list(names), words,
            np.array(bounds), lead, maps,
        )


def before(a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
    """Row by row: a < b (or <=) in lexicographic order."""
    unequal = a != b
    at = unequal.argmax(1)
    rows = np.arange(len(a))
    return np.where(unequal[rows, at], a[rows, at] < b[rows, at], or_equal)


def bound(array: np.ndarray, keys: np.ndarray, upper: bool) -> np.ndarray:
    """Binary search of every key in the sorted rows of `array`."""
    low, high = np.zeros(len(keys), np.int64), np.full(len(keys), len(array), np.int64)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        right = before(array[np.minimum(middle, len(array) - 1)], keys, upper) & open_
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)
    return low


def occurrences(words: np.ndarray, first: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(place in the shard, window) of every occurrence of a window inside one row."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(windows.keys) or not len(words):
        return none
    place = np.flatnonzero(windows.maps[0][words >> U64(44)])
    row_end = first[np.searchsorted(first, place, "right")]
    lead = words[place]
    for k in range(1, windows.lead):
        inside = place + k < row_end
        place, row_end = place[inside], row_end[inside]
        lead = mix(lead[inside] * U64(31) + words[place + k])
        seen = windows.maps[k][lead >> U64(44)]
        place, row_end, lead = place[seen], row_end[seen], lead[seen]
    if not len(place):
        return none
    suffixes = np.zeros((len(place), WINDOW), U64)
    for k in range(WINDOW):
        inside = place + k < row_end
        suffixes[inside, k] = words[place[inside] + k]
    order = np.lexsort(suffixes.T[::-1])
    suffixes, place = suffixes[order], place[order]
    low = bound(suffixes, windows.keys, False)
    full = np.where(np.arange(WINDOW) < windows.lengths[:, None], windows.keys, U64(0xFFFFFFFFFFFFFFFF))
    counts = bound(suffixes, full, True) - low
    which = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    return place[low[which] + within], which


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list]:
    """The benchmark's rows on the driver, at most about `block_bytes` of text at a time."""
    rows = benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).filter(F.col("t").isNotNull())
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    for k in range(blocks):
        yield rows.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k).collect() if blocks > 1 else rows.collect()


def mark_contaminated(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, dict[str, str]]:
    """`documents` (the columns in `keep`, default all) with n_words, n_hit, hit_runs and items.

    A word is hit if it lies inside an occurrence of a window: ten consecutive words of a benchmark
    item, or the whole item if shorter. `hit_runs` holds the maximal runs of hit words as pairs of
    int32 (first word, end); `items` the ids of the items whose windows occur. Also returns the names the
    four columns got, which differ from these where `documents` has such columns already.

    A null or empty text has no words and is never contaminated; so is everything if the benchmark is
    empty. Items without id count as one item with the id "". Repeated rows are marked alike. A benchmark
    above `block_bytes` of text is searched in blocks, one narrow pass over the documents each.
    """
    documents = documents.select(*(keep or documents.columns))
    names = {c: free_name(documents, c) for c in ("n_words", "n_hit", "hit_runs", "items")}
    fields = [T.StructField(names["n_words"], T.LongType()), T.StructField(names["n_hit"], T.LongType()),
              T.StructField(names["hit_runs"], T.BinaryType()), T.StructField(names["items"], T.ArrayType(T.StringType()))]
    schema, width = T.StructType([*documents.schema.fields, *fields]), len(documents.columns)
    column = documents.columns.index(text)
    marked = documents
    for block in benchmark_blocks(benchmark, item, item_text, block_bytes):
        shared = documents.sparkSession.sparkContext.broadcast(Windows.of(block))
        marked = marked.mapInArrow(lambda batches, shared=shared: mark_batches(batches, shared.value, column, width, list(names.values())), schema)
    return marked, names


def mark_batches(batches: Iterator[pa.RecordBatch], windows: Windows, column: int, width: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        earlier = batch.num_columns > width
        for lo, hi, data, offsets in chunks(batch.column(column)):
            words, first = words_of(data, offsets)
            place, which = occurrences(words, first, windows)
            delta = np.zeros(len(words) + 1, np.int64)
            np.add.at(delta, place, 1)
            np.add.at(delta, place + windows.lengths[which], -1)
            found: dict[int, set[str]] = {}
            rows = np.searchsorted(first, place, "right") - 1
            for row, window in np.unique(np.stack([rows, which], 1), axis=0).tolist():
                own = windows.places[windows.first_place[window] : windows.first_place[window + 1], 0]
                found.setdefault(row, set()).update(windows.items[k] for k in set(own.tolist()))
            if earlier:
                for row, (runs, items) in enumerate(zip(batch.column(width + 2)[lo:hi].to_pylist(), batch.column(width + 3)[lo:hi].to_pylist(), strict=True)):
                    pairs = np.frombuffer(runs, np.int32).reshape(-1, 2) + first[row]
                    np.add.at(delta, pairs[:, 0], 1)
                    np.add.at(delta, pairs[:, 1], -1)
                    found.setdefault(row, set()).update(items)
            hit = np.cumsum(delta[:-1]) > 0
            hits = np.concatenate([[0], np.cumsum(hit)])
            n_hit = hits[first[1:]] - hits[first[:-1]]
            runs = [hit_runs(hit[first[r] : first[r + 1]]) if n_hit[r] else b"" for r in range(hi - lo)]
            added = [
                pa.array(np.diff(first).astype(np.int64)), pa.array(n_hit.astype(np.int64)), pa.array(runs, pa.binary()),
                pa.array([sorted(found.get(r, ())) for r in range(hi - lo)], pa.list_(pa.string())),
            ]
            own = [batch.column(k).slice(lo, hi - lo) for k in range(width)]
            yield pa.RecordBatch.from_arrays([*own, *added], names=[*batch.schema.names[:width], *names])


def hit_runs(hit: np.ndarray) -> bytes:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return edges.astype(np.int32).tobytes()


def items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents, all columns, in which no benchmark window occurs."""
    marked, names = mark_contaminated(documents, benchmark, text, **options)
    return marked.filter(F.col(names["n_hit"]) == 0).select(*documents.columns)


def longest_matches(
    documents: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For every benchmark suffix that occurs for a window or more: its longest verbatim match and where.

    Columns item_id, item_word, n_words, doc_id (as text) and doc_word. Each shard reports its longest match of a
    suffix, and the longest over all shards stays; of equally long ones that with the smallest document id.
    """
    rows = documents.select(F.col(doc).cast("string").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for block in benchmark_blocks(benchmark, item, item_text, block_bytes):
        shared = documents.sparkSession.sparkContext.broadcast(Windows.of(block))
        part = rows.mapInArrow(lambda batches, shared=shared: longest_in_shards(batches, shared.value), LONGEST)
        found = part if found is None else found.unionByName(part)
    order = F.struct(F.col("n_words"), (-F.col("doc_word")).alias("w"))
    longest = F.max_by(F.struct("n_words", "doc_id", "doc_word"), order)
    return found.groupBy("item_id", "item_word").agg(longest.alias("m")).select("item_id", "item_word", "m.*")


LONGEST = "item_id string, item_word long, n_words long, doc_id string, doc_word long"


def longest_in_shards(batches: Iterator[pa.RecordBatch], windows: Windows) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, _, data, offsets in chunks(batch.column(1)):
            words, first = words_of(data, offsets)
            place, which = occurrences(words, first, windows)
            count = np.diff(windows.first_place)[which]
            place, at = np.repeat(place, count), np.concatenate([np.arange(windows.first_place[w], windows.first_place[w + 1]) for w in which] or [np.empty(0, np.int64)])
            _, item, offset = windows.places[at.astype(np.int64)].T
            size = np.repeat(windows.lengths[which], count)
            row = np.searchsorted(first, place, "right") - 1
            going = np.arange(len(place))
            while len(going):
                mine, theirs = place[going] + size[going], windows.item_first[item[going]] + offset[going] + size[going]
                inside = (mine < first[row[going] + 1]) & (theirs < windows.item_first[item[going] + 1])
                going, mine, theirs = going[inside], mine[inside], theirs[inside]
                going = going[words[mine] == windows.item_words[theirs]]
                size[going] += 1
            order = np.lexsort((place, -size, offset, item))
            head = np.ones(len(order), bool)
            head[1:] = (item[order][1:] != item[order][:-1]) | (offset[order][1:] != offset[order][:-1])
            best = order[head]
            yield pa.RecordBatch.from_pydict(
                {
                    "item_id": pa.array([windows.items[k] for k in windows.places[at.astype(np.int64)][best, 0]], pa.string()),
                    "item_word": pa.array(offset[best].astype(np.int64)), "n_words": pa.array(size[best].astype(np.int64)),
                    "doc_id": batch.column(0).take(pa.array(row[best] + lo)),
                    "doc_word": pa.array((place - first[row])[best].astype(np.int64)),
                }
            )
