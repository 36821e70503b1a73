from __future__ import annotations

import hashlib
import random
import re

import pytest

from stateloom.llm.decontaminate import decontaminate, items_digest, longest_matches, mark_contaminated

ITEMS = "item_id long, text string"


def words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (own := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[own]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest))
    return sorted(out, key=repr)


def marked(frame, items, **options):
    rows, names = mark_contaminated(frame, items, **options)
    from pyspark.sql import functions as F

    return sorted(
        (tuple(r) for r in rows.select("doc_id", names["n_words"], names["n_hit"], F.size(names["items"]), items_digest(F.col(names["items"]))).collect()), key=repr
    )


@pytest.mark.parametrize("block", [16 << 20, 300])
def test_against_brute_force(spark, documents, block):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["a", "B", "c1", "ü", "d-e", "É"]) for _ in range(n))
    items = [(k, text(rng.choice([0, 2, 5, 9, 10, 11, 14, 30]))) for k in range(30)] + [(None, "nothing but this here"), (99, None), (3, text(12))]
    docs = [(k, " ".join(rng.choice([text(8), items[rng.randrange(30)][1]]) for _ in range(6))) for k in range(1, 60)] + [(60, None), (61, "")]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    assert marked(frame, bench, block_bytes=block) == brute(docs, items)


def test_awkward_rows_and_empty_tables(spark, awkward):
    bench = spark.createDataFrame([(1, "one two three"), (2, "word1 word2 word3 word4 word5 word6 word7 word8 word9 word10 word11")], ITEMS)
    clean = decontaminate(awkward, bench)
    assert clean.columns == awkward.columns
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted([1, 2, None, 6, 7, 8], key=repr)
    assert decontaminate(awkward, bench.limit(0)).count() == awkward.count()
    assert decontaminate(awkward.limit(0), bench).count() == 0


def test_longest_match_and_its_place(spark, documents):
    sentence = "the quick brown fox jumps over the lazy dog near a quiet river bank today".split()
    docs = documents([" ".join(sentence[:11]), "x " + " ".join(sentence[:13]) + " y", "nothing"])
    found = longest_matches(docs, spark.createDataFrame([(4, " ".join(sentence))], ITEMS)).collect()
    by_word = {r.item_word: r for r in found}
    assert (by_word[0].n_words, by_word[0].doc_id, by_word[0].doc_word) == (13, "2", 1)
    assert by_word[3].n_words == 10 and 4 not in by_word
