from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stateloom.llm import neighbours
from stateloom.llm.neighbours import nearest_neighbours

ROWS = "vec_id long, embedding array<float>, node string"


def exact(rows, k=10):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and len(v) == 16]
    good = [(i, x) for i, x in good if np.isfinite(x).all() and x.any()]
    out = {}
    for q, x in good:
        if q % 20 == 0:
            near = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in good if i != q)
            out[q] = near[:k]
    return out


def test_recall_copies_ties_and_rows_without_a_part(spark):
    rng = np.random.default_rng(8)
    centers = rng.standard_normal((12, 16)) * 3
    rows = [(k, [float(v) for v in (centers[k % 12] + rng.standard_normal(16)).astype(np.float32)]) for k in range(900)]
    hot = rows[40][1]
    rows += [(k, hot) for k in range(900, 1200)]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [None] * 16), (2080, [1.0] * 3), (None, hot), (2100, [float("inf")] * 16), (2120, [])]
    frame = spark.createDataFrame([(*r, "n") for r in rows], ROWS)
    found = nearest_neighbours(frame, F.col("key") % 20 == 0).collect()
    want = exact(rows)
    got: dict = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(got) == set(want)
    assert all([x["rank"] for x in sorted(found, key=lambda r: r["rank"]) if x.query_id == q] == list(range(1, 11)) for q in got)
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hits >= 0.97 * 10 * len(want)
    assert got[40] == [(0.0, k) for k in range(900, 910)] and got[900] == [(0.0, 40)] + [(0.0, k) for k in range(901, 910)]
    by_id = {i: np.array(v, np.float32).astype(float) for i, v in rows[:1200]}
    assert all(abs(s - np.sqrt(((by_id[q] - by_id[i]) ** 2).sum())) < 1e-12 for q in got for s, i in got[q])


def test_few_rows_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0], "n"), (20, [1.0, 3.0], "n"), (20, [1.0, 3.0], "n"), (5, [1.0, 2.0], "n")], ROWS)
    rows = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest_neighbours(frame, F.col("key") % 20 == 0).collect())
    assert rows == [(0, 1, 5, 0.0), (0, 2, 20, 1.0), (20, 1, 0, 1.0), (20, 2, 5, 1.0)]
    assert nearest_neighbours(frame.limit(1), F.col("key") % 20 == 0).count() == 0
    assert nearest_neighbours(frame.limit(0), F.col("key") % 20 == 0).count() == 0


@pytest.mark.parametrize("far", [100.0, 1e5])
def test_a_small_far_group_gets_all_its_rows(spark, far):
    rng = np.random.default_rng(4)
    rows = [(k, [float(np.float32(v)) for v in rng.standard_normal(16)]) for k in range(595)]
    rows += [(600 + 20 * k, [float(np.float32(far + v)) for v in rng.standard_normal(16)]) for k in range(5)]
    frame = spark.createDataFrame([(*r, "n") for r in rows], ROWS)
    got: dict = {}
    for r in nearest_neighbours(frame, F.col("key") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = exact(rows)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for _, i in want[q]} & set(got[q])) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    for k in range(5):
        assert set(got[600 + 20 * k][:4]) == {600 + 20 * j for j in range(5)} - {600 + 20 * k}


def test_the_beam_grows_until_recall_is_as_wanted(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(k, [float(np.float32(v)) for v in rng.standard_normal(16)]) for k in range(1500)]
    frame = spark.createDataFrame([(*r, "n") for r in rows], ROWS)
    monkeypatch.setattr(neighbours, "BEAM", 11)
    monkeypatch.setattr(neighbours, "WIDE", 1)
    asked, seen = neighbours.search, []
    monkeypatch.setattr(neighbours, "search", lambda *a: seen.append(a[4]) or asked(*a))
    got: dict = {}
    for r in nearest_neighbours(frame, F.col("key") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = exact(rows)
    hits = sum(len({i for _, i in want[q]} & got[q]) for q in want)
    assert hits >= 0.93 * 10 * len(want) and seen == [11 << i for i in range(len(seen))]


def test_graph_and_search_are_a_row_a_part_also_with_many_parts(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(k, [float(np.float32(v)) for v in rng.standard_normal(16)]) for k in range(1500)]
    for name, value in (("PART", (100, 200)), ("SLICE", 64), ("MEMBERS", 300), ("OPENED", 100)):
        monkeypatch.setattr(neighbours, name, value)
    kept, written = neighbours.passing, {}

    def passing(df, name):
        table = kept(df, name)
        written.setdefault(name, []).append(table.rows.count())
        return table

    monkeypatch.setattr(neighbours, "passing", passing)
    frame = spark.createDataFrame([(*r, "n") for r in rows], ROWS)
    got: dict = {}
    for r in nearest_neighbours(frame, F.col("key") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = exact(rows)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for _, i in want[q]} & got[q]) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    assert set(written["graph"]) == {8} and max(written["search"]) <= 8


def test_a_hub_and_vectors_far_from_the_origin(spark):
    """All vectors but one lie far apart around it, and all far from the origin."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((700, 16))
    x = 1000 + 5 * x / np.linalg.norm(x, axis=1)[:, None]
    x[0] = 1000
    rows = [(k, [float(np.float32(v)) for v in row]) for k, row in enumerate(x)]
    frame = spark.createDataFrame([(*r, "n") for r in rows], ROWS)
    got: dict = {}
    for r in nearest_neighbours(frame, F.col("key") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = exact(rows)
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want) and all(len(v) == 10 for v in got.values())
    assert sorted(got[0]) == [(pytest.approx(s, abs=1e-12), i) for s, i in want[0]]


def test_lists_merge_as_by_hand():
    rng = np.random.default_rng(1)
    lists = [{int(v): float(rng.integers(1, 99)) for v in rng.choice(50, 4, replace=False)} for _ in range(6)]
    near, d, old = np.full((6, 5), -1), np.full((6, 5), np.inf, np.float32), np.zeros((6, 5), bool)
    for u, known in enumerate(lists):
        for place, (v, dist) in enumerate(sorted(known.items(), key=lambda x: x[1])):
            near[u, place], d[u, place], old[u, place] = v, dist, True
    u, v = rng.integers(0, 6, 60), rng.integers(0, 50, 60)
    dist = np.array([lists[a].get(int(b), 100.0 + int(b) - 99 * (b % 3 == 0)) for a, b in zip(u, v, strict=True)], np.float32)
    for width in (6, 62):  # places sorted with the numbers, and where they don't fit
        got = neighbours.merged(near, d, old, u, v, dist, 5, width)
        for a in range(6):
            want = lists[a] | {int(b): float(s) for b, s in zip(v[u == a], dist[u == a], strict=True)}
            want = sorted(want.items(), key=lambda x: (x[1], x[0]))[:5]
            assert [(int(n), float(s)) for n, s in zip(got[0][a], got[1][a], strict=True) if n >= 0] == want
            assert [bool(o) for n, o in zip(got[0][a], got[2][a], strict=True) if n >= 0] == [n in lists[a] for n, _ in want]
    assert (neighbours.merged(near[:, :0], d[:, :0], old[:, :0], u[:0], v[:0], dist[:0], 5, 6)[0] == -1).all()
