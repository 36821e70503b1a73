from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from stateloom.llm.buffers import U64
from stateloom.llm.components import components
from stateloom.llm.minhash import Options, components_by_document, keep_one_each, near_duplicates, sketches

BLANK = " \t\n\x0b\x0c\r"


def shingle_set(text, n):
    w = [x for x in "".join(" " if c in BLANK else c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ") if x]
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n):
    sets = {i: shingle_set(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            inverted[x].append(i)
    for i, s in sets.items():
        for j, c in Counter(j for x in s for j in inverted[x] if j < i).items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(rng, words, share):
    return [rng.choice(["zig", "zag", str(rng.random())]) if rng.random() < share else w for w in words]


@pytest.mark.parametrize("n", [4, 5])
def test_components_are_those_of_all_pairs(spark, n):
    rng = random.Random(n)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = [" ".join(edited(rng, base, s)) for s in [0.0, 0.01, 0.02, 0.03, 0.04, 0.05] * 20]  # one hot group at the threshold
    rows += [" ".join(base[:60] + [rng.choice(vocabulary) for _ in range(60)]) for _ in range(40)]  # a shared passage
    rows += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 200))) for _ in range(60)]
    rows += ["one", "One", "two words", "two  WORDS", "words two", "", None, "\n"]
    rng.shuffle(rows)
    rows = list(enumerate(rows, 1))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = components_by_document(near_duplicates(frame, options=Options(words=n))).collect()
    want = brute(rows, n)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_every_coordinate_fills_and_agreement_estimates_similarity():
    rng = np.random.default_rng(2)
    a = rng.integers(1, 1 << 63, 1000).astype(U64)
    both = np.concatenate([a, np.concatenate([a[:900], rng.integers(1, 1 << 63, 100).astype(U64)]), a[:1]])
    out = sketches(both, np.array([0, 1000, 2000, 2001, 2001]), 288)
    assert (out[:3] != 0).all() and not out[3].any()
    assert abs((out[0] == out[1]).mean() - 900 / 1100) < 0.08


def test_one_of_each_group_stays(spark, awkward):
    kept = keep_one_each(awkward)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    assert sorted((r.doc_id for r in rows), key=repr) == sorted([1, 2, 3, 5, None, 6, 7, 8], key=repr)
    assert all(r["class"] == "kept" for r in rows)
    assert keep_one_each(awkward.limit(0)).count() == 0


def test_components_of_chains_hubs_and_nothing(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (3, 2), (2, 3)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
