from __future__ import annotations

import random

import corpus_pipeline
from stateloom.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_in_order(spark, tmp_path):
    rng = random.Random(1)
    text = lambda: " ".join(rng.choice(["the", "and", "of", "house", "river", "stone", "light"]) + str(rng.randrange(50)) for _ in range(80))
    base, leak = text(), "this benchmark question has more than ten words in it for sure"
    rows = [(1, base, "en", "a", 1), (2, base + " end", "en", "b", 1), (3, text() + " " + leak, "en", "a", 1), (4, "123 456", "en", "a", 1), (5, None, "en", "a", 1)]
    rows += [(6, text() + " mail bob.12@mail.example.com", None, "a", 1)] + [(k, text(), "en", rng.choice("abc"), 1) for k in range(10, 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, ids = frame, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert docs.columns[:5] == frame.columns
    everything = {r[0] for r in rows}
    assert ids[0] == everything - {4, 5} and ids[1] == ids[0] - {2} and ids[2] == ids[3] == ids[1] - {3} and ids[4] <= ids[3]
    final = {r.doc_id: r for r in docs.collect()}
    assert 6 not in final or "bob.12@" not in final[6].text
    assert sorted((r.doc_id, r.taken) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted((r.doc_id, r.taken) for r in final.values())


def test_language_stage_rejects_wrong_labels(spark, tmp_path):
    rng = random.Random(2)
    syllables = {"en": "th wh ing er ly sh ou ea nd tion".split(), "de": "sch ü ei pf tz ö keit ung ver ge".split()}
    word = lambda lang: "".join(rng.choices(syllables[lang], k=rng.randint(1, 4)))
    said = lambda lang: " ".join(word(lang) for _ in range(150))
    rows = [(k, said(lang), lang, "a", 1) for k, lang in enumerate(["en", "de"] * 20)]
    rows += [(50, said("de"), "en", "a", 1), (51, said("en"), "de", "b", 1), (52, said("en") + " " + said("de"), "de", "a", 1), (53, said("de"), None, "a", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    ids = {r.doc_id for r in corpus_pipeline.language(spark, frame, str(tmp_path)).collect()}
    assert ids == {r[0] for r in rows} - {50, 51}
    assert corpus_pipeline.language(spark, frame.limit(0), str(tmp_path)).count() == 0


def test_queries_agree_with_sql(spark):
    with connect(SF) as con:
        for name, sql in LLM_ORACLES.items():
            assert difference(LLM_QUERIES[name](spark, SF), con, sql) is None, name


def test_every_operator_has_a_query():
    assert [sum(q.startswith(f"op{n}_") for q in LLM_QUERIES) for n in range(1, 11)] == [1] * 10
