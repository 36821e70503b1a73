"""Exact k-means against a plain loop over all centroids."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from stateloom.llm import centroids
from stateloom.llm.queries import LLM_ORACLES, LLM_QUERIES

from ..compare import connect, difference


def brute(rows, options):
    """{row number: (cluster, distance)} and the centroids, by measuring everything."""
    kept = [(i, [int(np.floor(options.scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == options.dimensions and all(x is not None and np.isfinite(x) for x in v)]
    points = [v for _, v in sorted((hashlib.sha256(f"{options.salt}{i}".encode()).hexdigest(), v) for i, v in kept)][: options.k]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), n) for n, p in enumerate(points))

    for _ in range(options.rounds):
        mine = [(place(v)[1], v) for _, v in kept]
        points = [[sum(c) // len(own) for c in zip(*own)] if (own := [v for n, v in mine if n == k]) else p for k, p in enumerate(points)]
    return sorted((i, place(v)[1], place(v)[0]) for i, v in kept), points


def test_against_brute_force(spark):
    rng = np.random.default_rng(7)
    options = centroids.Options(k=6, rounds=4, dimensions=5, scale=16)
    rows = [(i, [float(x) for x in rng.normal(size=5) * (1 + i % 3)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(150)]  # one vector holds a third of all rows
    rows += [(900, None), (901, []), (902, [1.0] * 4), (903, [1.0, None, 1.0, 1.0, 1.0]), (904, [float("nan")] * 5), (905, [float("-inf")] * 5), (906, [0.0] * 5)]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as cluster", "1 as distance", "2 as id", "3 as v")
    assigned, points = centroids.cluster(made, options=options)
    want, want_points = brute(rows, options)
    assert sorted(map(tuple, assigned.collect())) == want
    assert points.tolist() == want_points


def test_scan_measures_less_and_loses_nothing():
    rng = np.random.default_rng(3)
    points = rng.integers(-500, 500, (64, 16)) + rng.integers(-3000, 3000, (64, 1))
    points[10] = points[40]  # equal centroids: the smaller number wins
    vectors = np.concatenate([points[rng.integers(0, 64, 500)] + rng.integers(-40, 40, (500, 16)), points])
    cluster, distance, measured = centroids.nearest(vectors, centroids.Ordered(points))
    every = ((vectors[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert measured < 0.25 * every.size


def test_few_none_and_repeated_rows(spark):
    options = centroids.Options(dimensions=2, rounds=2)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assigned, points = centroids.cluster(empty, options=options)
    assert centroids.with_inertia(assigned, points).count() == 0
    few = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [5.0, -5.0])], empty.schema)
    assigned, points = centroids.cluster(few, options=options)
    out = centroids.with_inertia(assigned, points)
    assert len(points) == 3 and sorted((r.id or 0, r.cluster, r.distance, r.inertia) for r in out.collect()) == [(0, 2, 0, 0), (1, 0, 0, 0), (1, 0, 0, 0)]


def test_too_large_components_are_refused(spark):
    made = spark.createDataFrame([(1, [1e30, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="passes"):
        centroids.cluster(made, options=centroids.Options(dimensions=2))


def test_query_matches_sql(spark):
    small = "/root/testdata/sf0.001"
    with connect(small) as con:
        assert difference(LLM_QUERIES["op13_centroid_clustering"](spark, small), con, LLM_ORACLES["op13_centroid_clustering"]) is None
