from __future__ import annotations

import pytest

from stateloom.llm.queries import URL_RULES
from stateloom.llm.url_filter import Rule, build_trie, judge_urls, longest_match

CASES = [
    ("https://example.org/es/a", "example.org", "/es/a", "example.org/es/", "block"),
    ("https://WWW.Example.ORG/es", "www.example.org", "/es", "org/", "allow"),
    ("http://a.example.org/en/19?x=/es/", "a.example.org", "/en/19", "example.org/en/1", "block"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://shop.com/de/x#y", "shop.com", "/de/x", "com/de/", "block"),
    ("http://shop.com/fr/", "shop.com", "/fr/", "com/fr/", "allow"),
    ("http://shop.com", "shop.com", "", None, "allow"),
    ("http://org?q", "org", "", None, "allow"),
    ("no scheme/es/", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("x://", "", "", None, "allow"),
    ("http://a.org/one://b.com/de/", "a.org", "/one://b.com/de/", "org/", "allow"),
]


@pytest.mark.parametrize("most", [100, 0])
def test_cases_by_trie_and_by_join(spark, most):
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(CASES)] * 2, "page_id int, url string, rule string")
    rows = judge_urls(pages, URL_RULES, max_trie_rules=most).select("page_id", "judged.*").collect()
    assert len(rows) == 2 * len(CASES)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == CASES[r.page_id][1:], CASES[r.page_id]


def test_longest_rule_wins_and_block_wins_a_tie():
    rules = [Rule("a.b", "/x", "allow"), Rule("a.b", "/x", "block"), Rule("b", "/x/y/z", "block"), Rule("a.b", "/x/y/", "allow")]
    trie = build_trie(rules)
    assert longest_match(trie, "q.a.b", "/xx").verdict == "block"
    assert longest_match(trie, "a.b", "/x/y/z").text == "a.b/x/y/"
    assert longest_match(trie, "c.b", "/x/y/zz").text == "b/x/y/z"
    assert longest_match(trie, "b", "/x/y/") is None
    assert longest_match(trie, "a.b.c", "/x") is None


def test_empty_table(spark):
    assert judge_urls(spark.createDataFrame([], "page_id int, url string"), URL_RULES).count() == 0
