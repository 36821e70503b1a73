from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stateloom.llm.mixing import mix, quotas, route, turns, words


def test_words_and_quotas(spark):
    rows = spark.createDataFrame([("a b\tc",), ("",), (None,), ("  x\x0b\x0cy\xa0z ",), ("one",)], "t string")
    assert [r[0] for r in rows.select(words(F.col("t"))).collect()] == [3, 0, 0, 2, 1]
    sizes = {"a": 10, "b": 100, "c": 100, None: 0}
    weights = turns([3, 1, 2], list(sizes))
    assert weights == {"a": 3, "b": 1, "c": 2, None: 3}
    out = quotas(sizes, weights, 1.5, 2)
    assert out["a"] == 20 and out[None] == 0 and out["c"] == pytest.approx(2 * out["b"])
    assert sum(out.values()) == pytest.approx(315)
    assert quotas({}, {}, 1.5, 2) == {} and quotas({"a": 0}, {"a": 1.0}, 1.5, 2) == {"a": 0.0}


def test_flow_meets_quotas_with_the_fewest_repeats():
    patterns = [(("a",), 100), (("a", "b"), 50), (("b",), 10)]
    flow = route(patterns, {"a": 120.0, "b": 40.0}, 2)
    assert flow[0, "a"] + flow.get((1, "a"), 0) == 120 and flow.get((1, "b"), 0) + flow[2, "b"] == 40
    # all of this fits into first copies: 100 + 50 + 10
    assert flow[0, "a"] == 100 and flow[2, "b"] == 10
    assert sum(route([(("a",), 10)], {"a": 50.0}, 2).values()) == 20


def test_taken_words_come_near_the_targets(spark):
    rng = random.Random(6)
    rows = [(k, " ".join(["w"] * rng.choice([1, 5, 40, 200])), rng.choice(["a", "b", "c", "d", None])) for k in range(500)] + [(600, None, "a"), (601, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed, plan = mix(frame, "text", F.array("source"), [3.0, 1.0, 2.0])
    out = mixed.select("doc_id", "source", "mixed.*").collect()
    assert len(out) == len(rows) and plan["column"] == "mixed"
    taken: dict = {}
    for r in out:
        assert r.taken % max(r["size"], 1) == 0 and 0 <= r.taken <= 2 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, target in plan["targets"].items():
        assert abs(taken[s] - target) <= 2
    again = mix(frame.repartition(7), "text", F.array("source"), [3.0, 1.0, 2.0])[0].select("doc_id", "mixed.taken")
    assert sorted(again.collect()) == sorted((r.doc_id, r.taken) for r in out)


def test_overlapping_sources(spark):
    rows = [(k, "w " * 10, ["a", "b"] if k % 3 == 0 else ["a"] if k % 3 == 1 else ["b"]) for k in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, s array<string>")
    mixed, plan = mix(frame, "text", F.col("s"), [1.0, 1.0], share=0.5, max_patterns=3)
    total = mixed.agg(F.sum("mixed.taken")).first()[0]
    assert abs(total - sum(plan["targets"].values())) <= 10
    with pytest.raises(ValueError, match="more than 2"):
        mix(frame, "text", F.col("s"), [1.0, 1.0], max_patterns=2)


@pytest.mark.parametrize("seed", range(4))
def test_one_very_long_document_does_not_spoil_the_target(spark, seed):
    texts = ["w " * 200] * 1500 + ["w " * 100_000]
    frame = spark.createDataFrame([(k, t, "a") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    mixed, plan = mix(frame, "text", F.array("source"), [1.0], share=1.4, seed=seed)
    taken = mixed.agg(F.sum("mixed.taken")).first()[0]
    assert plan["targets"] == {"a": pytest.approx(560_000)} and abs(taken - 560_000) <= 200


@pytest.mark.parametrize("seed", range(3))
def test_independent_check_of_the_mix(spark, seed):
    """Quotas by water-filling in fractions, and no document left that would have brought a source nearer."""
    rng = random.Random(seed)
    rows = [(k, " ".join(["w"] * int(rng.paretovariate(0.7))), rng.choice("abcc") if rng.random() < 0.9 else None) for k in range(700)]
    rows += [(9000, "w " * 37, "a")] * 50  # rows that agree in all are taken alike
    frame = spark.createDataFrame([(k, t[:40_000], s) for k, t, s in rows], "doc_id long, text string, source string")
    mixed, plan = mix(frame, "text", F.array("source"), [3.0, 1.0, 2.0], seed=seed)
    out = mixed.select("doc_id", "source", "mixed.*").collect()
    sizes: dict = {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    weight = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [3, 1, 2, 3], strict=True))
    low, high = 0.0, 1e9
    for _ in range(200):  # the level at which capped shares add up
        level = (low + high) / 2
        low, high = (level, high) if sum(min(weight[s] * level, 2 * sizes[s]) for s in sizes) < 1.5 * sum(sizes.values()) else (low, level)
    for s in sizes:
        target = min(weight[s] * low, 2 * sizes[s])
        assert plan["targets"][s] == pytest.approx(target, abs=1)
        mine = [r for r in out if r.source == s]
        gap = target - sum(r.taken for r in mine)
        copies = [r.taken // r["size"] for r in mine if r["size"]]
        level = min(copies) if gap > 0 else max(copies)
        movable = [r["size"] * (50 if r.doc_id == 9000 else 1) for r in mine if r["size"] and r.taken // r["size"] == level]
        assert max(copies) - min(copies) <= 1 and (abs(gap) < min(movable) + 1), (s, gap)


def test_awkward_rows_and_empty_tables(spark, awkward):
    mixed, plan = mix(awkward, "text", F.array("source"), [3.0, 1.0, 2.0])
    assert plan["column"] == "mixed_" and mixed.columns == [*awkward.columns, "mixed_"] and mixed.count() == awkward.count()
    assert {r["mixed"] for r in mixed.collect()} == {"kept"}
    empty, plan = mix(awkward.limit(0), "text", F.array("source"), [3.0, 1.0, 2.0])
    assert empty.count() == 0 and plan["targets"] == {}
