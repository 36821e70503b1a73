"""Phrases whose words stand together more often than apart, by set-oriented mining of occurrence relations.

R(k) holds the places at which a frequent phrase of k words may stand, sorted by piece and position. It is
persisted in chunks of bounded size (one row a chunk; texts are never split, so no phrase crosses
chunks), and one round goes from k to k + 1 words:

1. Group-count: each chunk has named its distinct phrases and counted them; the counts are summed by
   phrase over all chunks. Words are one row a chunk; longer phrases are dealt by hash into slices of bounded size,
   to which a chunk sends all it has in one packed row.
2. Semi-join: phrases below `least` go; a slice tells each chunk which of its phrases stay.
3. Merge-join: in each chunk the places left are joined with themselves by piece and next position, in the order they
   are stored. Both parts of a phrase of k + 1 words are frequent if it is.

Words get numbers when the frequent ones are known (a number stands for a language and a word), so phrases are
compared by numbers, exactly. Null languages are `und`, null texts are empty, and rows that repeat count each time.
An empty table gives an empty result. Only language and text are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stateloom.llm.buffers import BASE, LOWER, U64, chunks, mix, text_bytes, word_spans
from stateloom.llm.shared import passing, settled

# What ends a piece, and what parts the words of one.
PIECE_ENDS = [*b".,;:!?", 10, 11, 12, 13]
BLANKS = [32, 9]
CHUNK = 12 << 20  # bytes of text; a document is not split, so that one more may follow
SLICES = 32  # least number of slices in which phrases are counted
SLICE_WORDS = 2 << 20  # words of text for which there is one slice; a slice has fewer phrases than that
SALTS = 64  # groups in which a language's best are found before they meet


@dataclass(frozen=True)
class Options:
    longest: int = 5
    least: int = 100
    inside_percent: int = 100  # a phrase goes if a longer one around it has this share of its places
    top: int = 2000

    def __post_init__(self):
        if self.longest < 2 or self.least < 1 or not 0 < self.inside_percent <= 100 or self.top < 1:
            raise ValueError("options out of range")


def marks(values: list[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[values] = True
    return out


ENDS = marks(PIECE_ENDS)
IN_WORD = ~marks(PIECE_ENDS + BLANKS)


def packed(**columns) -> bytes:
    table = pa.table(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def relation(position: np.ndarray, u: np.ndarray) -> bytes:
    """Places in the order of their positions, and which of the chunk's phrases stands at each."""
    return packed(step=np.diff(position, prepend=0).astype(np.int32), u=u.astype(np.int32))


def places_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    table = unpacked(data)
    return np.cumsum(table.column("step").to_numpy(), dtype=np.int64), table.column("u").to_numpy().astype(np.int64)


RELATION = "chunk long, places binary, phrases binary"


def words_of(langs: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array, np.ndarray]:
    """Position of each word (pieces are a step apart), its number here, and of each number language, word and count."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, IN_WORD)
    breaks = np.zeros(len(starts) + 1, bool)
    breaks[np.searchsorted(starts, np.flatnonzero(ENDS[data]))] = True
    breaks[first] = True
    position = np.cumsum(1 + breaks[:-1])
    cuts = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data[IN_WORD[data]])]).dictionary_encode()
    named = langs.fill_null("und").dictionary_encode()
    lang = np.repeat(named.indices.to_numpy().astype(np.int64), np.diff(first))
    both, u, n = np.unique(lang * max(1, len(spelled.dictionary)) + spelled.indices.to_numpy(), return_inverse=True, return_counts=True)
    of_lang, of_word = np.divmod(both, max(1, len(spelled.dictionary)))
    return position, u, named.dictionary.take(pa.array(of_lang)), spelled.dictionary.take(pa.array(of_word)), n


def first_relation(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to chunks: places of words, and the chunk's distinct words with their counts.

    A chunk is named after its task and the distinct words that the task has met before, so that name plus
    number within the chunk is a number that no other word of any chunk has.
    """
    base = TaskContext.get().partitionId() << 40
    for langs, texts in filled(batches):
        position, u, lang, word, n = words_of(langs, texts)
        if len(n):
            phrases = packed(n=n, lang=lang.cast(pa.string()), word=word.cast(pa.binary()))
            yield pa.RecordBatch.from_pylist([{"chunk": base, "places": relation(position, u), "phrases": phrases}], schema=CHUNK_ROWS)
            base += len(n)


def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Languages and texts of one chunk after the other, across batches."""
    waiting, size = [], 0
    for batch in batches:
        for lo, hi, data, _ in chunks(batch.column("text"), CHUNK >> 3, 1 << 30):
            waiting.append(batch.slice(lo, hi - lo))
            size += len(data)
            if size >= CHUNK:
                yield together(waiting)
                waiting, size = [], 0
    if waiting:
        yield together(waiting)


def together(batches: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    table = pa.Table.from_batches(batches)
    # 64-bit offsets: a few long texts may pass 2 GB
    return tuple(table.column(c).cast(pa.large_string()).combine_chunks() for c in ("lang", "text"))


CHUNK_ROWS = pa.schema([("chunk", pa.int64()), ("places", pa.binary()), ("phrases", pa.binary())])


def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each of a chunk's distinct words."""
    for batch in batches:
        for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("phrases")):
            table = unpacked(blob.as_py())
            many = table.num_rows
            table = table.append_column("chunk", pa.array(np.full(many, chunk))).append_column("u", pa.array(np.arange(many, dtype=np.int32)))
            yield from table.to_batches(max_chunksize=1 << 16)


def hashed(words: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(words[0]), U64)
    for w in words:
        out = mix(out * U64(BASE) + w.astype(U64))
    return out


SLICED = "slice long, chunk long, part binary"
SLICED_ARROW = pa.schema([("slice", pa.int64()), ("chunk", pa.int64()), ("part", pa.binary())])


def sliced(size: int, slices: int):
    """Chunks with their distinct phrases to a row for each slice and chunk, which holds the chunk's phrases of that slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("phrases")):
                table = unpacked(blob.as_py())
                of = (hashed([table.column(k).to_numpy() for k in keys(size)]) % U64(slices)).astype(np.int64)
                order = np.argsort(of, kind="stable")
                table = table.take(order).append_column("u", pa.array(order.astype(np.int32))).combine_chunks()
                of, lead = np.unique(of[order], return_index=True)
                parts = [packed(**{c: table.column(c)[lo:hi] for c in table.column_names}) for lo, hi in zip(lead, np.append(lead[1:], len(order)))]
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(np.full(len(of), chunk)), pa.array(parts, pa.binary())], schema=SLICED_ARROW)

    return run


def grouped(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal phrases stand together, and where each of them begins in it."""
    hashes = hashed(words)
    order = np.argsort(hashes)
    changed = lambda: np.any([np.diff(w[order]) != 0 for w in words], axis=0)
    if (changed() & (np.diff(hashes[order]) == 0)).any():  # equal hashes of different phrases
        order = np.lexsort(words)
    return order, np.flatnonzero(np.concatenate([[True], changed()]))


def counting(size: int, least: int):
    """One slice to the phrases that are frequent (a row each), and for each chunk to which of its phrases they are (a row a chunk)."""
    schema = pa.schema([("chunk", pa.int64()), ("u", pa.binary()), *((k, pa.int64()) for k in keys(size)), ("f", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        parts = [unpacked(part.as_py()) for part in rows.column("part")]
        bounds = np.cumsum([0] + [part.num_rows for part in parts])
        table = pa.concat_tables(parts).combine_chunks()
        words = [table.column(k).to_numpy() for k in keys(size)]
        order, lead = grouped(words)
        f = np.add.reduceat(table.column("n").to_numpy()[order], lead)
        often = f >= least
        stays = np.zeros(len(order), bool)
        stays[order] = np.repeat(often, np.diff(np.append(lead, len(order))))
        u = table.column("u").to_numpy()
        one = order[lead[often]]
        phrases = {"u": pa.nulls(len(one), pa.binary()), "f": f[often], **{k: w[one] for k, w in zip(keys(size), words)}}
        replies = [u[lo:hi][stays[lo:hi]].tobytes() for lo, hi in zip(bounds[:-1], bounds[1:])]
        nothing = {k: pa.nulls(len(parts), pa.int64()) for k in ("f", *keys(size))}
        return pa.concat_tables([
            pa.table({"chunk": pa.nulls(len(one), pa.int64()), **phrases}).select(schema.names).cast(schema),
            pa.table({"chunk": rows.column("chunk"), "u": pa.array(replies, pa.binary()), **nothing}).select(schema.names).cast(schema),
        ])

    return run


def words_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column("phrases"):
            yield from unpacked(blob.as_py()).group_by("lang").aggregate([("n", "sum")]).rename_columns(["lang", "n"]).to_batches()


def extending(size: int):
    """A chunk's relation of phrases of `size` words and the frequent ones of them to the relation one word longer."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return CHUNK_ROWS.empty_table()
        position, u = places_of(left.column("places")[0].as_py())
        if size == 1:
            right = right.sort_by("w1").combine_chunks()
            frequent, words = right.column("u").to_numpy(), [right.column("w1").to_numpy()]
        else:
            frequent = np.sort(np.concatenate([np.frombuffer(part.as_py(), np.int32) for part in right.column("u")]))
            known = unpacked(left.column("phrases")[0].as_py())
            words = [known.column(k).to_numpy()[frequent] for k in keys(size)]
        row = np.full(int(u.max()) + 1, -1, np.int64)
        row[frequent] = np.arange(len(frequent))
        at = row[u]
        position, at = position[at >= 0], at[at >= 0]
        follows = np.flatnonzero(np.diff(position) == 1)
        if not len(follows):
            return CHUNK_ROWS.empty_table()
        both, u, n = np.unique(at[follows] * len(frequent) + at[follows + 1], return_inverse=True, return_counts=True)
        a, b = np.divmod(both, len(frequent))
        phrases = packed(n=n, **{k: w[a] for k, w in zip(keys(size), words)}, **{f"w{size + 1}": words[-1][b]})
        return pa.Table.from_pylist(
            [{"chunk": left.column("chunk")[0].as_py(), "places": relation(position[follows], u), "phrases": phrases}], schema=CHUNK_ROWS
        )

    return run


def keys(size: int, start: int = 1) -> list[str]:
    return [f"w{i}" for i in range(start, start + size)]


def frequent_phrases(documents: DataFrame, lang: str, text: str, options: Options) -> tuple[DataFrame, list[DataFrame]]:
    """Frequent words with their language's number of words, and for each size from 2 the frequent phrases (w1.., f)."""
    rows = documents.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    places = passing(rows.mapInArrow(first_relation, RELATION), "places-1")
    named = places.rows.select("chunk", "phrases").mapInArrow(distinct_words, "n long, lang string, word binary, chunk long, u int")
    of_word = Window.partitionBy("lang", "word")
    number = (F.col("chunk") + F.col("u")).alias("number")
    counted = named.select("chunk", "u", "lang", "word", "n", number).select(
        "chunk", "u", "lang", "word", F.sum("n").over(of_word).alias("f"), F.min("number").over(of_word).alias("w1"), "number"
    )
    here = F.col("w1") == F.col("number")  # one row of each word says what it is
    left = passing(
        counted.filter(F.col("f") >= options.least).select("chunk", "u", "w1", *(F.when(here, F.col(c)).alias(c) for c in ("f", "lang", "word"))), "left-1"
    )
    sizes = places.rows.select("phrases").mapInArrow(words_by_language, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("words"))
    words = settled(
        left.rows.filter("f is not null").join(sizes, "lang").select("w1", "lang", F.col("word").cast("string").alias("word"), "words", "f"), "frequent-words"
    )
    total = words.select("lang", "words").distinct().agg(F.sum("words")).first()[0] or 0
    slices = max(SLICES, total // SLICE_WORDS)
    found = []
    for size in range(2, options.longest + 1):
        chosen = left.rows.select("chunk", "u", "w1") if size == 2 else left.rows.filter("chunk is not null").select("chunk", "u")
        relations = places.rows.drop("phrases") if size == 2 else places.rows  # words are named by what comes back
        joined = relations.groupBy("chunk").cogroup(chosen.groupBy("chunk"))
        before, places = (places, left), passing(joined.applyInArrow(extending(size - 1), RELATION), f"places-{size}")
        for done in before[: 1 if size > 2 else 2]:
            done.drop()
        dealt = places.rows.select("chunk", "phrases").mapInArrow(sliced(size, slices), SLICED)
        counted = "chunk long, u binary, " + ", ".join(f"{k} long" for k in keys(size)) + ", f long"
        left = passing(dealt.groupBy("slice").applyInArrow(counting(size, options.least), counted), f"left-{size}")
        found.append(left.rows.filter("chunk is null").select(*keys(size), "f"))
    places.drop()
    return words, found


def joined_on(left: DataFrame, right: DataFrame, on: list[str], names: list[str]) -> DataFrame:
    """`right`'s key columns w1.. meet `left`'s columns `on`; its other columns are renamed by `names`."""
    renamed = right.select(*(F.col(k).alias(f"{names[0]}{k}") for k in keys(len(on))), *(F.col(c).alias(f"{names[0]}{c}") for c in names[1:]))
    same = [left[o] == renamed[f"{names[0]}{k}"] for o, k in zip(on, keys(len(on)))]
    return left.join(renamed, same).drop(*(f"{names[0]}{k}" for k in keys(len(on))))


def described(words: DataFrame, found: list[DataFrame]) -> list[DataFrame]:
    """Phrases by size with text, and the counts of their first and last words for each cut."""
    empty = F.array().cast("array<bigint>")
    shorter = words.select("w1", "lang", "words", "f", F.col("word").alias("phrase"), F.col("word").alias("last"), empty.alias("firsts"), empty.alias("rests"))
    out = []
    for size, phrases in enumerate(found, 2):
        both = joined_on(phrases, shorter, keys(size - 1), ["a_", "f", "lang", "words", "phrase", "firsts"])
        both = joined_on(both, shorter, keys(size - 1, 2), ["b_", "f", "last", "rests"])
        shorter = settled(
            both.select(
                *keys(size), "f", F.col("a_lang").alias("lang"), F.col("a_words").alias("words"), F.concat_ws(" ", "a_phrase", "b_last").alias("phrase"),
                F.col("b_last").alias("last"), F.concat("a_firsts", F.array("a_f")).alias("firsts"), F.concat("b_rests", F.array("b_f")).alias("rests"),
            ),
            f"described-{size}",
        )
        out.append(shorter)
    return out


def whole(name: str) -> str:
    return f"cast({name} as decimal(19,0))"


def scored(phrases: DataFrame, size: int) -> DataFrame:
    """Adds the lowest score of all cuts; of equal ones, that of the earliest cut."""
    cuts = ", ".join(
        f"named_struct('score', (1000 * {whole('f')} * {whole('words')}) div ({whole(f'firsts[{k - 1}]')} * {whole(f'rests[{size - k - 1}]')}), "
        f"'cut', {k}, 'l', firsts[{k - 1}], 'r', rests[{size - k - 1}])"
        for k in range(1, size)
    )
    return phrases.withColumn("cut", F.expr(f"array_min(array({cuts}))"))


def not_inside(phrases: DataFrame, longer: DataFrame | None, size: int, options: Options) -> DataFrame:
    """Phrases that no longer one holds in the given share of their places.

    One word more is enough to look at: between a phrase and any longer one around it stand phrases that are at least as frequent as the longer.
    """
    if longer is None:
        return phrases
    around = longer.select(*keys(size), "f").unionByName(longer.select(*(F.col(a).alias(b) for a, b in zip(keys(size, 2), keys(size))), "f"))
    around = around.groupBy(*keys(size)).agg(F.max("f").alias("held"))
    return phrases.join(around, keys(size), "left").filter(
        F.expr(f"held is null or 100 * {whole('held')} < {options.inside_percent} * {whole('f')}")
    )


def collocations(documents: DataFrame, lang: str = "lang", text: str = "text", options: Options = Options()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language."""
    words, found = frequent_phrases(documents, lang, text, options)
    phrases = described(words, found)
    every = None
    for i, rows in enumerate(phrases):
        size, longer = i + 2, phrases[i + 1] if i + 1 < len(phrases) else None
        kept = scored(not_inside(rows, longer, size, options), size).select(
            "lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", F.col("words").alias("n"), "cut.score"
        )
        every = kept if every is None else every.unionByName(kept)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's best come from the best of its salted groups
    salted = every.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= options.top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= options.top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
