from __future__ import annotations

import random
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from stateloom.llm.langid import held_out, identify, keep_identified, learn_profiles

WORDS = {
    "en": "the and with that have this from they would there their what about which when make can like time just".split(),
    "de": "der die und nicht sich auch eine werden schön über größe straße zwischen durch zeit jahr immer noch".split(),
    "el": "και δεν είναι για που από στην αυτό θα με την τους μια όπως".split(),
}


def grams(text):
    out, word = Counter(), ""
    for w in "".join(c.lower() if c.isalpha() else " " for c in text).split():
        for n in (1, 2, 3):
            padded = f" {w} "
            for k in range(len(padded) - n + 1):
                if padded[k : k + n] != " ":
                    out[padded[k : k + n]] += 1
    return out


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def ranked(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))][:size]


@pytest.mark.parametrize("block", [500, 1])
def test_against_brute_force(spark, block):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choices(WORDS[lang], k=rng.randint(1, 40))) + rng.choice(["", "!", " 12"]), lang) for k, lang in enumerate(list(WORDS) * 20)]
    rows += [(900, None, "en"), (901, "", "de"), (902, "123 --", "de"), (903, "what about straße", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    size = 60
    judged, names = identify(frame, learn_profiles(frame, size=size), size=size, block_languages=block)
    totals = {}
    for _, text, lang in rows:
        if text and lang:
            totals.setdefault(lang, Counter()).update(grams(text))
    profiles = {lang: {g: k for k, g in enumerate(ranked(c, size))} for lang, c in totals.items()}
    for r in judged.collect():
        own = ranked(grams(r.text or ""), size)
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        away = {lang: sum(abs(p[g] - k) if g in p else size for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(away), key=away.get)
        assert r.lang_pred == best and r.score == pytest.approx(1 - away[best] / (size * len(own)))
    assert names == {"lang_pred": "lang_pred", "score": "score"}


def test_held_out_is_crc32_of_the_text(spark):
    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_awkward_rows(spark, awkward):
    kept = keep_identified(awkward, learn_profiles(awkward))
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([3, 4, 5, 5, None, 8], key=repr)
    none = learn_profiles(awkward.limit(0))
    assert keep_identified(awkward, none).count() == 0 and keep_identified(awkward.limit(0), none).count() == 0


def test_wrong_labels_are_rejected(spark):
    rng = random.Random(5)
    said = lambda lang, k=60: " ".join(rng.choices(WORDS[lang], k=k))
    rows = [(k, said(lang), lang) for k, lang in enumerate(list(WORDS) * 15)]
    rows += [(900, said("el"), "en"), (901, said("en") + " " + said("de"), "en"), (902, said("en") + " " + said("de"), "de")]
    rows += [(903, said("de"), None), (904, said("de"), "xx"), (905, said("de"), "en"), (905, said("de"), "en"), (906, "1 2", "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("claimed_score", F.lit(1))
    profiles = learn_profiles(frame.filter("doc_id < 900"), size=60)
    every = {r[0] for r in rows}
    for block in (500, 1):  # the claimed language and the predicted one may come in different blocks
        judged, names = identify(frame, profiles, size=60, block_languages=block, claimed="lang")
        assert names["claimed_score"] == "claimed_score_"
        found = {(r.doc_id, r.lang): r for r in judged.collect()}
        assert all(r.claimed_score_ == r.score for (k, lang), r in found.items() if k < 900)
        assert [found[k].claimed_score_ for k in ((903, None), (904, "xx"), (906, "en"))] == [None] * 3
        assert found[900, "en"].claimed_score_ < found[900, "en"].score - 0.35
    ids = lambda df: {r.doc_id for r in df.collect()}
    profiles = learn_profiles(frame.filter("doc_id < 900"))
    assert ids(keep_identified(frame, profiles, lang="lang")) == every - {900, 905, 906}
    assert ids(keep_identified(frame, profiles)) == every - {906}
    assert ids(keep_identified(frame, profiles, wanted=["el"])) == {r[0] for r in rows[:45] if r[2] == "el"} | {900}
    assert keep_identified(frame, profiles, lang="lang").columns == frame.columns
