from __future__ import annotations

import hashlib
import random
import sys
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from stateloom.llm import substrings
from stateloom.llm.shared import shared_base
from stateloom.llm.suffixes import common_prefixes, suffix_array


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest(), rest))
    return sorted(out, key=repr)


def found(frame, **options):
    return sorted(((*tuple(r)[:5], bytes(r.kept_text)) for r in substrings.remove_repeats(frame, **options).collect()), key=repr)


@pytest.mark.parametrize("contexts", [1024, 1])
def test_against_brute_force(spark, contexts):
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("abcé \n") for _ in range(n))
    passages = [letters(n) for n in (199, 200, 201, 260, 400, 150)]
    texts = [letters(rng.randint(0, 300)) + rng.choice(passages) + letters(rng.randint(0, 300)) + rng.choice(["", passages[3][20:]]) for _ in range(60)]
    texts += [None, "", "x", "a" * 199, "b" * 200, "c" * 201, "d" * 900, "ab" * 400, passages[4], passages[4], texts[0]]
    rows = list(enumerate(texts, 1)) + [(1, texts[0]), (None, texts[3]), (2, "unlike the other row 2")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame, shard_contexts=contexts) == brute(rows, 200)


def test_long_texts_are_read_in_segments(spark, monkeypatch):
    rng = random.Random(4)
    one = "".join(rng.choice("abcdefgh") for _ in range(3000))
    rows = [(1, one), (2, "zz" + one[700:1900] + "yy"), (3, one[:1000][::-1])]
    want = brute(rows, 200)
    data = np.frombuffer(one.encode(), np.uint8)
    whole = substrings.contexts_of(data, np.array([0, len(data)]), 200, 32)
    assert int(whole[4].sum()) == len(data) - 199
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_awkward_rows_and_empty_tables(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = substrings.remove_repeats(awkward).collect()
    by_id = {r.doc: r for r in got}
    assert len(got) == len(rows)
    assert by_id[3].n_removed == by_id[3].n_bytes == len(rows[2][1]) and by_id[3].n_spans == 1
    assert by_id[1].n_bytes == 0 and by_id[8].n_removed == 0
    assert substrings.remove_repeats(awkward.limit(0)).count() == 0


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    for t in range(200):
        x = rng.integers(0, rng.integers(1, 4), rng.integers(0, 150)).astype(np.uint8)
        x = np.concatenate([x, x[: len(x) // 2], x]) if t % 3 == 0 else x
        b = x.tobytes()
        order, rank = suffix_array(x)
        want = sorted(range(len(b)), key=lambda i: b[i:])
        assert order.tolist() == want and all(rank[order[k]] == k for k in range(len(b)))
        shared = common_prefixes(x, order, rank)
        for k in range(1, len(b)):
            i, j, n = want[k - 1], want[k], 0
            while max(i, j) + n < len(b) and b[i + n] == b[j + n]:
                n += 1
            assert shared[k] == n


def test_shards_are_searched_in_bulk():
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcd") for _ in range(260)) for _ in range(200)] * 2
    rng.shuffle(texts)
    rows = [
        {"anchor": i // 8, "salt": 0, "salts": 1, "doc": None if i == 5 else i, "text_hash": i, "start": 3, "windows": 61, "bytes": texts[i].encode()}
        for i in range(400)
    ]
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([(k, pa.binary() if k == "bytes" else pa.int64()) for k in rows[0]]))
    list(substrings.search_shards(iter([batch.slice(0, 8)]), 200))  # imports what is needed
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    got = list(substrings.search_shards(iter([batch.slice(0, 150), batch.slice(150)]), 200))
    sys.setprofile(None)
    found = [r for part in got for r in part.to_pylist()]
    assert [(r["doc"], r["spans"]) for r in found] == [(r["doc"], [{"a": 3, "b": 263}]) for r in rows]
    assert calls < 2 * len(rows)  # nothing runs context by context


def test_tables_and_shuffle_files_go_with_their_last_reader(spark):
    rng = random.Random(6)
    one, two = ("".join(rng.choice("abcdef") for _ in range(700)) for _ in range(2))
    rows = [(1, one), (2, one[:400] + two), (3, "x" + one[90:]), (4, two[::-1]), (5, two[100:500])]
    tables = Path(shared_base(spark)) / f"stateloom-{spark.sparkContext.applicationId}"
    folders = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString())
    shuffled = lambda: {f for d in folders for f in Path(d).glob("*/shuffle_*")}
    stood, lay = set(tables.glob("*")), shuffled()
    frame = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {t.name.rsplit("-", 1)[0] for t in set(tables.glob("*")) - stood} == {"texts-again", "shards"}
    end = time.monotonic() + 20
    while (left := shuffled() - lay) and time.monotonic() < end:  # Spark removes them behind the query's end
        time.sleep(0.1)
    assert not left
    assert sorted(((*tuple(r)[:5], bytes(r.kept_text)) for r in frame.collect()), key=repr) == brute(rows, 200)
