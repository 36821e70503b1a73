"""Language identification by rank-order n-gram profiles and their out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateloom.llm.buffers import U64, chunks
from stateloom.llm.shared import free_name

PROFILE = 400  # n-grams of a profile, of languages and of documents
MARGIN = 0.35  # by which another language scores higher than the claimed one if the text is in that language only
BLOCK_LANGUAGES = 500  # profiles that one pass over the documents broadcasts
SPACE = 32

_tables: list[np.ndarray] = []


def letters_lowered() -> np.ndarray:
    """By code point: the lower-case letter, or a blank for everything that is no letter."""
    if not _tables:
        table = np.full(0x110000, SPACE, np.uint32)
        for c in range(0x110000):
            if (s := chr(c)).isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _tables.append(table)
    return _tables[0]


def grams(codes: np.ndarray) -> np.ndarray:
    """All 1-, 2- and 3-grams inside the words, whose ends count as one blank: 21 bits a character."""
    blank = codes == SPACE
    codes = codes[~blank | np.concatenate([[True], ~blank[:-1]])]
    if codes[0] != SPACE:
        codes = np.concatenate([[SPACE], codes])
    if codes[-1] != SPACE:
        codes = np.concatenate([codes, [SPACE]])
    one = codes.astype(U64)
    blank = one == SPACE
    two = (one[:-1] << U64(21)) | one[1:]
    three = (two[:-1] << U64(21)) | one[2:]
    return np.concatenate([one[~blank], two, three[~blank[1:-1]]])


def rows_of_codes(column: pa.Array) -> Iterator[tuple[int, np.ndarray | None]]:
    """Row number and lowered letters of each row; None if it has no letter."""
    for lo, hi, data, offsets in chunks(column):
        codes = letters_lowered()[np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
        starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        for row in range(lo, hi):
            own = codes[starts[row - lo] : starts[row - lo + 1]]
            yield row, own if (own != SPACE).any() else None


def gram_counts(documents: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, gram, n over whole texts: summed inside each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        sizes: dict[str, int] = {}

        def merge(name: str) -> None:
            found, n = np.unique(np.concatenate(waiting.pop(name)), return_counts=True)
            if name in totals:
                both, back = np.unique(np.concatenate([totals[name][0], found]), return_inverse=True)
                n = np.bincount(back, np.concatenate([totals[name][1], n])).astype(np.int64)
                found = both
            totals[name], sizes[name] = (found, n), 0

        def out() -> Iterator[pa.RecordBatch]:
            for name in [*waiting]:
                merge(name)
            for name, (found, n) in totals.items():
                yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(found), pa.string()), "gram": pa.array(found.view(np.int64)), "n": pa.array(n)})
            totals.clear()

        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, codes in rows_of_codes(batch.column(1)):
                if codes is None:
                    continue
                name = names[row]
                waiting.setdefault(name, []).append(own := grams(codes))
                sizes[name] = sizes.get(name, 0) + len(own)
                if sizes[name] > 2_000_000:
                    merge(name)
            if len(sizes) > 64:  # many languages: hand on what is gathered
                yield from out()
                sizes.clear()
        yield from out()

    rows = documents.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counted = rows.mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> DataFrame:
    """lang, gram, place: the `size` most frequent n-grams of each language, places from 0.

    Every row with text and lang counts in full. Equal counts are ordered by the n-gram.
    """
    known = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    ranked = gram_counts(known, text, lang).withColumn("place", F.row_number().over(order) - 1)
    return ranked.filter(F.col("place") < size).select("lang", "gram", "place")


class Profiles:
    """Places by n-gram (sorted) and language; `size` where a language lacks the n-gram."""

    def __init__(self, rows: list, size: int):
        self.size, self.langs = size, sorted({r["lang"] for r in rows})
        number = {name: k for k, name in enumerate(self.langs)}
        packed = np.array([r["gram"] for r in rows], np.int64).view(U64)
        self.grams, at = np.unique(packed, return_inverse=True)
        self.places = np.full((len(self.grams), len(self.langs)), size, np.int32)
        self.places[at, [number[r["lang"]] for r in rows]] = [r["place"] for r in rows]

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """By language: 1 - sum of displacements / greatest sum."""
        found, n = np.unique(grams(codes), return_counts=True)
        own = found[np.argsort(-n, kind="stable")[: self.size]]
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        there = self.places[at[known]]
        here = np.flatnonzero(known)[:, None]
        away = np.where(there == self.size, self.size, np.abs(there - here)).sum(0) + self.size * int((~known).sum())
        return 1 - away / (self.size * len(own))


def identify(
    documents: DataFrame, profiles: DataFrame, text: str = "text", keep: list[str] | None = None, size: int = PROFILE,
    block_languages: int = BLOCK_LANGUAGES, claimed: str | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """`documents` (the columns in `keep`, default all) with lang_pred and score, and the names these got.

    A null text or one without a letter is `und` with score 0, as is every row if no profile was learnt.
    Of equal scores the first language by name is taken. With `claimed`, a column of languages that rows
    are said to be in, claimed_score follows: that language's score, null if the row has no letter or names none
    that was learnt. Predictions do not depend on it. Repeated rows are judged alike. `block_languages` profiles are broadcast at a time (`size` rows each);
    more languages take further narrow passes, of which the best score stays.
    """
    documents = documents.select(*(keep or documents.columns))
    kinds = {"lang_pred": T.StringType(), "score": T.DoubleType()} | ({"claimed_score": T.DoubleType()} if claimed else {})
    names = {c: free_name(documents, c) for c in kinds}
    schema = T.StructType([*documents.schema.fields, *[T.StructField(names[c], kinds[c]) for c in kinds]])
    places = Places(documents.columns.index(text), documents.columns.index(claimed) if claimed else None, len(documents.columns))
    languages = [r[0] for r in profiles.select("lang").distinct().sort("lang").toLocalIterator()]
    blocks = [languages[k : k + block_languages] for k in range(0, len(languages), block_languages)] or [[]]
    judged = documents
    for block in blocks:
        rows = profiles.filter(F.col("lang").isin(block)).collect() if block else []
        shared = documents.sparkSession.sparkContext.broadcast(Profiles(rows, size))
        judged = judged.mapInArrow(lambda b, shared=shared: judge(b, shared.value, places, list(names.values())), schema)
    return judged, names


@dataclass(frozen=True)
class Places:
    """Where a batch has the text and the claimed language, and how many columns it has without the verdict."""

    text: int
    claimed: int | None
    width: int


def judge(batches: Iterator[pa.RecordBatch], profiles: Profiles, places: Places, names: list[str]) -> Iterator[pa.RecordBatch]:
    number = {lang: k for k, lang in enumerate(profiles.langs)}
    for batch in batches:
        n, width = batch.num_rows, places.width
        verdict = [["und"] * n, [0.0] * n, [None] * n][: len(names)]
        if batch.num_columns > width:  # a block of languages came before
            verdict = [batch.column(width + k).to_pylist() for k in range(len(names))]
        claims = None if places.claimed is None else batch.column(places.claimed).cast(pa.string()).to_pylist()
        if profiles.langs:
            for row, codes in rows_of_codes(batch.column(places.text)):
                if codes is not None:
                    scores = profiles.scores(codes)
                    best = int(scores.argmax())
                    if verdict[0][row] == "und" or scores[best] > verdict[1][row]:
                        verdict[0][row], verdict[1][row] = profiles.langs[best], float(scores[best])
                    if claims is not None and claims[row] in number:
                        verdict[2][row] = float(scores[number[claims[row]]])
        added = [pa.array(v, t) for v, t in zip(verdict, (pa.string(), pa.float64(), pa.float64()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:width], *added], names=[*batch.schema.names[:width], *names])


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether crc32 of the key as text is divisible by `folds`; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == 0


def keep_identified(
    documents: DataFrame, profiles: DataFrame, text: str = "text", lang: str | None = None, margin: float = MARGIN, wanted: list[str] | None = None,
) -> DataFrame:
    """The documents, all columns, of which a language could be told.

    With `lang`, a document goes if the language it is said to be in scores lower than the predicted one by `margin`
    or more: it stands under a wrong label. A text in two languages scores about alike in both and stays, as does one
    whose language is null or was not learnt. With `wanted`, documents predicted to be in another language go too.
    """
    judged, names = identify(documents, profiles, text, claimed=lang)
    stay = F.col(names["lang_pred"]) != "und"
    if lang is not None:
        stay &= F.coalesce(F.col(names["score"]) - F.col(names["claimed_score"]) < margin, F.lit(True))
    if wanted is not None:
        stay &= F.col(names["lang_pred"]).isin(wanted)
    return judged.filter(stay).select(*documents.columns)
