"""Near-duplicates: fast similarity sketches, banding, exact verification, connected components.

Documents with equal shingle sets form a class; sketches, candidates and links are between classes.
A sketch places every shingle hash into one of `COORDINATES` bins, round after round with fresh hashes,
and a bin keeps the least value of the first round that reached it; after as many rounds as bins, round i
sends everything to bin i, so that every coordinate fills. Bands of equal coordinates give candidates.
Only components matter, so a bucket need not be compared pair by pair: its members first meet a leader
drawn for this bucket. Where that leaves several components in a bucket, the rest is settled exactly by
prefix filtering: two similar sets share one of their rarest shingles, so only documents of different
components that do are compared. Edited copies whose edits nobody shares drop out there without a
comparison. Links are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stateloom.llm.buffers import LOWER, U64, chunks, mix, prefix_sums, span_hashes, word_spans
from stateloom.llm.components import components
from stateloom.llm.shared import free_name, kept

COORDINATES = 288
ROWS = 6  # coordinates of a band: at similarity 0.8, all 48 bands miss with probability 5e-7
HELD_BYTES = 64 << 20  # shingle sets that a verifying task keeps for the next batch
MAX = U64(0xFFFFFFFFFFFFFFFF)

WORD_BYTES = np.ones(256, bool)
WORD_BYTES[32] = False
WORD_BYTES[9:14] = False


@dataclass(frozen=True)
class Options:
    words: int = 5
    percent: int = 80
    coordinates: int = COORDINATES
    rows: int = ROWS


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within the row, and where each row begins.

    A row with fewer words is one shingle of all its words; one without words has none.
    """
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, WORD_BYTES)
    own = span_hashes(prefix_sums(low), starts, ends)
    rolled = own.copy()
    for k in range(1, words):
        n = max(0, len(own) - k)
        rolled[:n] = mix(rolled[:n] * U64(31) + own[k : k + n])
    parts, bounds = [], [0]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            part = np.sort(rolled[a : b - words + 1])
            part = part[np.concatenate([[True], part[1:] != part[:-1]])]
        elif b > a:
            part = own[a : a + 1] + U64(b - a)
            for k in range(a + 1, b):
                part = mix(part * U64(33) + own[k])
        else:
            part = own[:0]
        parts.append(part)
        bounds.append(bounds[-1] + len(part))
    return np.concatenate(parts) if parts else own, np.array(bounds)


def sketches(hashes: np.ndarray, bounds: np.ndarray, t: int) -> np.ndarray:
    """rows x t coordinates; rows without shingles stay 0."""
    n = len(bounds) - 1
    out, filled = np.zeros((n, t), U64), np.zeros((n, t), bool)
    sizes = np.diff(bounds)
    filled[sizes == 0] = True
    row = np.repeat(np.arange(n), sizes)
    for i in range(2 * t):
        open_rows = ~filled.all(1)
        if not open_rows.any():
            break
        here = open_rows[row]
        hashes, row = hashes[here], row[here]
        at = np.cumsum(open_rows) - 1
        value = mix(hashes + U64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        bins = ((value >> U64(32)) * U64(t) >> U64(32)).astype(np.int64) if i < t else np.full(len(value), i - t)
        least = np.full(int(open_rows.sum()) * t, MAX)
        np.minimum.at(least, at[row] * t + bins, value)
        least = least.reshape(-1, t)
        new = (least != MAX) & ~filled[open_rows]
        rows = np.flatnonzero(open_rows)[np.nonzero(new)[0]]
        columns = np.nonzero(new)[1]
        out[rows, columns] = mix(least[new] + U64(i))
        filled[rows, columns] = True
    return out


def bands(sketch: np.ndarray, rows: int) -> np.ndarray:
    n, t = sketch.shape
    parts = sketch.reshape(n, t // rows, rows)
    out = np.broadcast_to(np.arange(t // rows, dtype=U64), (n, t // rows)).copy()
    for k in range(rows):
        out = mix(out * U64(31) + parts[:, :, k])
    return out


PROFILE = "doc long, text_hash long, n_shingles long, class binary, bands array<long>"


def profiles(documents: DataFrame, doc: str, text: str, options: Options) -> DataFrame:
    """Per row: set size, class (fingerprint of the whole shingle set, null without shingles) and bands."""
    rows = documents.select(F.col(doc).cast("long").alias("doc"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(2)):
                hashes, bounds = shingles(data, offsets, options.words)
                sums = [np.concatenate([[U64(0)], np.cumsum(mix(hashes ^ U64(salt)))]) for salt in (1, 0x5851F42D4C957F2D)]
                prints = np.stack([s[bounds[1:]] - s[bounds[:-1]] for s in sums], 1)
                banded = bands(sketches(hashes, bounds, options.coordinates), options.rows)
                sizes = np.diff(bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(sizes.astype(np.int64)),
                     pa.array([p.tobytes() if s else None for p, s in zip(prints, sizes, strict=True)], pa.binary()),
                     pa.ListArray.from_arrays(np.arange(hi - lo + 1, dtype=np.int32) * banded.shape[1], banded.ravel().view(np.int64))],
                    names=["doc", "text_hash", "n_shingles", "class", "bands"],
                )

    return rows.mapInArrow(profile, PROFILE)


def set_reader(words: int):
    """A function that turns a column of classes and one of texts into {class: sorted shingle hashes}."""

    def read(classes: list, texts: pa.Array) -> dict[bytes, np.ndarray]:
        out = {}
        for lo, hi, data, offsets in chunks(texts):
            hashes, bounds = shingles(data, offsets, words)
            out |= {classes[lo + k]: hashes[bounds[k] : bounds[k + 1]] for k in range(hi - lo)}
        return out

    return read


def verified(pairs: DataFrame, texts: DataFrame, options: Options) -> DataFrame:
    """The pairs (a, b) of classes whose full shingle sets are similar enough."""
    left = texts.select(F.col("class").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("b_text"))
    read = set_reader(options.words)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[bytes, np.ndarray] = {}
        for batch in batches:
            if sum(x.nbytes for x in sets.values()) > HELD_BYTES:
                sets = {}
            sides = [batch.column(0).to_pylist(), batch.column(1).to_pylist()]
            for side, column in ((0, 2), (1, 3)):
                new = {c: k for k, c in enumerate(sides[side]) if c not in sets}
                if new:
                    sets |= read(list(new), batch.column(column).take(pa.array(list(new.values()))))
            good = []
            for a, b in zip(*sides, strict=True):
                small, large = sorted((sets[a], sets[b]), key=len)
                at = np.searchsorted(large, small)
                common = int((large[np.minimum(at, len(large) - 1)] == small).sum()) if len(large) else 0
                good.append(100 * common >= options.percent * (len(small) + len(large) - common))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(good, pa.bool_())) for k in (0, 1)], names=["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text").mapInArrow(verify, "a binary, b binary")


def near_duplicates(documents: DataFrame, doc: str = "doc_id", text: str = "text", options: Options = Options()) -> DataFrame:
    """One row per row of `documents`: doc, text_hash, n_shingles, class, component (a class, null without links).

    A null text, or one without words, has no shingles, no class and no links. Repeated rows share a class.
    """
    rows = kept(profiles(documents, doc, text, options), "near-profiles")
    classes = rows.filter("class is not null").groupBy("class").agg(F.first("bands").alias("bands"), F.first("n_shingles").alias("size"))
    entries = kept(classes.select("class", "size", F.explode("bands").alias("bucket")), "near-bands")
    # what is known of a key is written before it meets that key's rows: only then can a hot key's side be split
    crowded = entries.groupBy("bucket").agg(F.min("class").alias("x"), F.max("class").alias("y")).filter("x <> y")
    members = kept(entries.join(kept(crowded.select("bucket"), "near-crowded"), "bucket"), "near-members")
    wanted = members.select("class").distinct()
    chosen = rows.join(wanted, "class").groupBy("class").agg(F.min(F.struct("doc", "text_hash")).alias("r")).select("class", "r.*")
    sources = documents.select(F.col(doc).cast("long").alias("doc"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    same = sources["doc"].eqNullSafe(chosen["doc"]) & (sources["text_hash"] == chosen["text_hash"])
    texts = kept(sources.join(chosen, same).select("class", "text").dropDuplicates(["class"]), "near-texts")
    tested = kept(fitting(pairs_with_leaders(members), options), "near-pairs")
    links = kept(verified(tested, texts, options), "near-links")
    placed = members.join(by_class(links), "class", "left").withColumn("root", F.coalesce("component", "class")).drop("component")
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("bucket")
    placed = placed.join(kept(mixed, "near-mixed"), "bucket").select("class", "size", "root").distinct()
    rest = fitting(pairs_by_prefix(kept(placed, "near-open"), texts, options), options).join(tested, ["a", "b"], "left_anti")
    roots = by_class(links.unionByName(kept(verified(kept(rest, "near-pairs"), texts, options), "near-links")))
    return rows.join(roots, "class", "left").select(
        "doc", "text_hash", "n_shingles", "class", F.coalesce("component", "class").alias("component")
    )


def by_class(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("class"), F.col("root").alias("component"))


def pairs_with_leaders(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's leader: another one in every bucket, even where members recur."""
    leaders = members.groupBy("bucket").agg(F.min_by(F.struct("class", "size"), F.xxhash64("class", "bucket")).alias("l"))
    joined = members.join(kept(leaders, "near-leaders"), "bucket").filter(F.col("class") != F.col("l.class"))
    return joined.select("class", "size", F.col("l.class").alias("other"), F.col("l.size").alias("other_size"))


def pairs_by_prefix(nodes: DataFrame, texts: DataFrame, options: Options) -> DataFrame:
    """Pairs of different components that share a shingle among the rarest of both: an exact filter.

    Of a set of n, the n - ceil(n * percent / 100) + 1 rarest are enough, by one order for all sets. Of a shingle's
    documents only those outside its most common component look for partners.
    """
    read = set_reader(options.words)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = read(batch.column(0).to_pylist(), batch.column(1))
            sizes = [len(x) for x in sets.values()]
            yield pa.RecordBatch.from_pydict(
                {"class": pa.array(np.repeat(np.array(list(sets), object), sizes), pa.binary()), "shingle": pa.array(np.concatenate([*sets.values()]).view(np.int64))}
            )

    tokens = kept(texts.join(nodes, "class", "left_semi").mapInArrow(explode, "class binary, shingle long"), "near-tokens")
    common = kept(tokens.groupBy("shingle").agg(F.count("*").alias("n")), "near-counts")
    in_class = Window.partitionBy("class")
    ranked = tokens.join(common, "shingle").select(
        "class", "shingle", "n", F.row_number().over(in_class.orderBy("n", "shingle")).alias("place"), F.count_if(F.col("n") > 1).over(in_class).alias("known")
    )
    needed = F.col("size") - F.ceil(F.col("size") * options.percent / 100) + 1
    useful = (F.col("place") <= needed) & (F.col("n") > 1) & (100 * F.col("known") >= options.percent * F.col("size"))
    postings = kept(ranked.join(nodes, "class").filter(useful).select(
        "shingle", "class", "size", "known", "root", (F.col("place") - F.col("size") + F.col("known")).alias("rank")
    ), "near-postings")
    by_root = postings.groupBy("shingle", "root").count().groupBy("shingle")
    shared = by_root.agg(F.max_by("root", F.struct("count", "root")).alias("major"), F.count("*").alias("roots")).filter("roots > 1")
    mixed = postings.join(kept(shared.select("shingle", "major"), "near-majors"), "shingle")
    seekers = mixed.filter("root <> major").drop("major")
    others = mixed.select("shingle", *[F.col(c).alias("other" if c == "class" else f"other_{c}") for c in ("class", "size", "known", "root", "rank")])
    # only shingles known from another set can be common: if this is the first that is, so many at most. A similar
    # pair passes at its first common shingle, whatever becomes of it at the others
    most = 1 + F.least(F.col("known") - F.col("rank"), F.col("other_known") - F.col("other_rank"))
    enough = (100 + options.percent) * most >= options.percent * (F.col("size") + F.col("other_size"))
    apart = (F.col("root") != F.col("other_root")) & enough & size_fits(F.col("size"), F.col("other_size"), options.percent)
    return seekers.join(others, "shingle").filter(apart).select("class", "size", "other", "other_size")


def size_fits(x: Column, y: Column, percent: int) -> Column:
    """Sets of other sizes cannot be similar enough."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def fitting(pairs: DataFrame, options: Options) -> DataFrame:
    fits = size_fits(F.col("size"), F.col("other_size"), options.percent)
    return pairs.filter(fits).select(F.greatest("class", "other").alias("a"), F.least("class", "other").alias("b")).distinct()


def components_by_document(found: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id (least document id of the component) and kept, per row.

    A row without shingles is a component of its own. Null ids come after all others.
    """
    least = found.filter("component is not null").groupBy("component").agg(F.min("doc").alias("component_id"))
    # rows without shingles get keys of their own, so that they spread and find nothing
    own = found.withColumn("component", F.coalesce("component", F.encode(F.concat(F.lit("row"), F.xxhash64("doc", "text_hash")), "UTF-8")))
    joined = own.join(least, "component", "left")
    component = F.coalesce("component_id", "doc")
    return joined.select(
        F.col("doc").alias("doc_id"), "text_hash", "n_shingles", component.alias("component_id"), F.col("doc").eqNullSafe(component).alias("kept")
    )


def keep_one_each(documents: DataFrame, doc: str = "doc_id", text: str = "text", options: Options = Options()) -> DataFrame:
    """The documents, all columns, one of each component: that with the least id (null ids last).

    Of rows repeated in id and text one stays. Rows without shingles stay, one of each id and text.
    """
    found = near_duplicates(documents, doc, text, options)
    order = F.struct(F.col("doc").isNull(), "doc", "text_hash")
    linked = found.filter("component is not null").groupBy("component").agg(F.min(order).alias("r"))
    alone = found.filter("component is null").select("doc", "text_hash").distinct()
    stay = linked.select("r.doc", "r.text_hash").unionByName(alone)
    mark, print_ = free_name(documents, "row_doc"), free_name(documents, "row_text_hash")
    keyed = documents.withColumn(mark, F.col(doc).cast("long")).withColumn(print_, F.xxhash64(text))
    stay = stay.select(F.col("doc").alias(mark), F.col("text_hash").alias(print_))
    same = keyed[mark].eqNullSafe(stay[mark]) & (keyed[print_] == stay[print_])
    return keyed.join(stay, same, "left_semi").dropDuplicates([mark, print_]).select(*documents.columns)
