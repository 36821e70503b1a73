"""Collocations against counting every phrase in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from stateloom.llm import phrases
from stateloom.llm.queries import LLM_ORACLES, LLM_QUERIES

from ..compare import connect, difference

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, o):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, o.longest + 1) for i in range(len(words) - k + 1))
    often = {p: f for p, f in counts.items() if f >= o.least}
    inside = Counter()
    for (lang, w), f in often.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i : i + k]] = max(inside[lang, w[i : i + k]], f)
    out = {}
    for (lang, w), a in often.items():
        if len(w) > 1 and 100 * inside[lang, w] < o.inside_percent * a:
            cuts = [(1000 * a * sizes[lang] // (often[lang, w[:k]] * often[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), often[lang, w[:k]], often[lang, w[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, sizes[lang], -score) for lang, got in out.items() for rank, (score, a, p, l, r) in enumerate(sorted(got)[: o.top], 1)
    )


def corpus(seed, rows=120):
    rng = random.Random(seed)
    stock = [a + b for a in "aÄb" for b in ["", "c", "ü", "dd"]]
    sets = [" ".join(rng.choice(stock) for _ in range(rng.randint(2, 7))) for _ in range(8)]
    texts = ["".join(rng.choice([rng.choice(stock), rng.choice(sets)]) + rng.choice([" ", " ", "\t", " . ", ", ", "!\n", "\r", "  "]) for _ in range(rng.randint(0, 50))) for _ in range(rows)]
    made = [(rng.choice(["en", "en", "de", None, "und"]), t) for t in texts]
    return made + [("en", None), (None, ""), ("fr", " .,\n"), ("en", sets[0])] + [("en", f"{sets[1]} {sets[2]}")] * 60  # a third are copies


@pytest.mark.parametrize("options", [phrases.Options(least=20), phrases.Options(longest=3, least=5, top=7), phrases.Options(longest=6, least=9, inside_percent=60)])
def test_against_brute_force(spark, options):
    rows = corpus(options.least)
    made = spark.createDataFrame(rows, "lang string, text string").repartition(6).selectExpr("*", "'x' as w1", "1 as chunk", "2 as rank")
    assert sorted(map(tuple, phrases.collocations(made, options=options).collect())) == brute(rows, options)


def test_words_pieces_and_languages():
    position, u, lang, word, n = phrases.words_of(pa.array(["a", None, "a"]), pa.array(["X y.x", "x", "y x"]))
    assert position.tolist() == [2, 3, 5, 7, 9, 10]
    assert [(lang[i].as_py(), word[i].as_py()) for i in u] == [("a", b"x"), ("a", b"y"), ("a", b"x"), ("und", b"x"), ("a", b"y"), ("a", b"x")]
    assert n.sum() == 6


@pytest.mark.parametrize("collide", [False, True])
def test_a_chunk_sends_one_row_to_a_slice(monkeypatch, collide):
    """However many phrases it has; frequent ones are found exactly even if hashes are equal."""
    rng = np.random.default_rng(5)
    sets = {c: np.unique(rng.integers(0, 70, (4000, 3)), axis=0) for c in (7, 8, 9)}
    counts = {c: rng.integers(1, 50, len(w)) for c, w in sets.items()}
    blobs = [phrases.packed(n=counts[c], **dict(zip(("w1", "w2", "w3"), w.T))) for c, w in sets.items()]
    batch = pa.RecordBatch.from_arrays([pa.array(list(sets)), pa.array(blobs, pa.binary())], names=["chunk", "phrases"])
    rows = pa.Table.from_batches(phrases.sliced(3, 4)(iter([batch])))
    assert rows.num_rows == 3 * 4 and sum(phrases.unpacked(p).num_rows for p in rows.column("part").to_pylist()) == sum(map(len, sets.values()))
    if collide:
        monkeypatch.setattr(phrases, "hashed", lambda words: words[0].astype(np.uint64) % np.uint64(3))
    want = Counter()
    for c, w in sets.items():
        want.update({tuple(p): int(n) for p, n in zip(w.tolist(), counts[c])})
    got, told = {}, {c: set() for c in sets}
    for part in range(4):
        for r in phrases.counting(3, 60)(rows.filter(pa.compute.equal(rows.column("slice"), part))).to_pylist():
            if r["chunk"] is None:
                got[r["w1"], r["w2"], r["w3"]] = r["f"]
            else:
                told[r["chunk"]].update(tuple(sets[r["chunk"]][u].tolist()) for u in np.frombuffer(r["u"], np.int32))
    assert got == {p: f for p, f in want.items() if f >= 60} and got
    assert told == {c: {tuple(p) for p in w.tolist()} & set(got) for c, w in sets.items()}


def test_products_beyond_64_bits(spark):
    row = (1, 2, 4 * 10**15, "en", 9 * 10**17, "p", "q", [5 * 10**15], [7 * 10**15])
    made = spark.createDataFrame([row], "w1 long, w2 long, f long, lang string, words long, phrase string, last string, firsts array<long>, rests array<long>")
    assert phrases.scored(made, 2).first().cut.score == 1000 * row[2] * row[4] // (row[7][0] * row[8][0])


def test_awkward_rows(spark, awkward):
    options = phrases.Options(least=2)
    rows = [(r.lang, r.text) for r in awkward.collect()]
    assert sorted(map(tuple, phrases.collocations(awkward, options=options).collect())) == brute(rows, options)
    assert phrases.collocations(awkward.limit(0), options=options).count() == 0


def test_query_matches_sql(spark):
    small = "/root/testdata/sf0.01"
    with connect(small) as con:
        assert difference(LLM_QUERIES["op11_phrase_collocations"](spark, small), con, LLM_ORACLES["op11_phrase_collocations"]) is None
