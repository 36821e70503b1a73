"""Words under repeated windows against a dictionary of all windows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from stateloom.llm import factoring
from stateloom.llm.queries import LLM_ORACLES, LLM_QUERIES

from ..compare import connect, difference


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = {p for k in range(len(w) - window + 1) if i is not None and least[tuple(w[k : k + window])] < i for p in range(k, k + window)}
        left = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest(), left))
    return sorted(out, key=repr)


def passages(seed):
    """Copies whole, in part and changed, one passage in a third of all rows, words out of a small stock."""
    rng = random.Random(seed)
    word = lambda n: " ".join(rng.choice("abcdefgh") + rng.choice(["", "é", "x", "yy"]) for _ in range(n))
    shared = [word(rng.randint(4, 40)) for _ in range(6)]
    texts = [word(rng.randint(0, 60)) for _ in range(30)]
    texts += [f"{word(rng.randint(0, 9))} {shared[0]}\n\t{word(rng.randint(0, 9))}" for _ in range(40)]
    texts += [" ".join(rng.choice(shared) for _ in range(rng.randint(1, 6))) for _ in range(30)]
    texts += [rng.choice(texts) for _ in range(20)] + ["same " * 50, "same " * 30, "same same", None, "", " \n "]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [rows[0], rows[1], (None, shared[0]), (None, shared[0]), (3, shared[1] + " " + shared[1])]


@pytest.mark.parametrize("options", [factoring.Options(), factoring.Options(window=5, anchor=3), factoring.Options(window=6, anchor=2, hot=5), factoring.Options(window=4, anchor=4, hot=1)])
def test_against_brute_force(spark, options):
    rows = passages(options.hot)
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr("*", "'x' as id", "'y' as chunk", "1 as places")
    got = factoring.remove_repeated_windows(made, options=options)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, options.window)


def test_many_chunks_and_small_blocks(spark, monkeypatch):
    rows = passages(5)
    column = pa.record_batch({"id": pa.array([i for i, _ in rows]), "text": pa.array([t for _, t in rows])})
    options = factoring.Options(window=5, anchor=3)
    monkeypatch.setattr(factoring, "BLOCK", 1)
    words = factoring.Words(column.column("text"))
    first, n, anchor, own = factoring.judged_segments(words, factoring.ids_of(pa.Table.from_batches([column])), options)
    texts = [words.data[words.starts[f] : words.ends[f + k + 3]].tobytes() for f, k in zip(first, n)]
    order = np.lexsort((own, anchor))
    block = pa.record_batch({"key": anchor[order], "lo": own[order], "hi": own[order], "chunk": np.zeros(len(order), int), "u": order.astype(np.int32), "text": pa.array([texts[i] for i in order])})
    parse = factoring.parse_blocks(options)
    small = pa.Table.from_batches(list(parse(iter([block.slice(i, 3) for i in range(0, len(order), 3)])))).sort_by("u")
    monkeypatch.setattr(factoring, "BLOCK", 1 << 30)
    assert small.equals(pa.Table.from_batches(list(parse(iter([block])))).sort_by("u").cast(small.schema))


def test_equal_hashes_are_told_apart_by_bytes(monkeypatch):
    texts = ["a b c d e f g", "x b c d e f y", "b c d e", "q r s t u v w"]
    words = factoring.Words(pa.array(texts))
    want = factoring.first_windows(words, 4)[1].tolist()
    monkeypatch.setattr(factoring.Words, "runs", lambda self, size: np.full(self.n - size + 1, 7, factoring.U64))
    assert factoring.first_windows(words, 4)[1].tolist() == want


def test_awkward_rows(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert sorted(map(tuple, factoring.remove_repeated_windows(awkward).collect()), key=repr) == brute(rows, 13)
    assert factoring.remove_repeated_windows(awkward.limit(0)).count() == 0


def test_query_matches_sql(spark):
    small = "/root/testdata/sf0.001"
    with connect(small) as con:
        assert difference(LLM_QUERIES["op12_substring_dedup"](spark, small), con, LLM_ORACLES["op12_substring_dedup"]) is None
