"""Allow and block lists over urls: a trie of reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """`host` with all its subdomains, and paths that start with `path` (from its slash on)."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def build_trie(rules: Iterable[Rule]) -> dict:
    """Nested nodes. Keys: ("h", label) goes to a longer host, ("p", segment) behind one more "/".

    The last part of a rule's path, which need not be a whole segment, stands in the node's "tails".
    Of two rules with equal host and path, block wins.
    """
    root: dict = {}
    for rule in sorted(set(rules), key=lambda r: r.verdict != "block"):
        node = root
        for label in reversed(rule.host.translate(str.maketrans(UPPER, LOWER)).split(".")):
            node = node.setdefault(("h", label), {})
        *segments, tail = rule.path.split("/")
        for segment in segments:
            node = node.setdefault(("p", segment), {})
        node.setdefault("tails", {}).setdefault(tail, rule)
    return root


def longest_match(trie: dict, host: str, path: str) -> Rule | None:
    """The rule with the longest host, then the longest path, that fits; None without one."""
    best, node = None, trie
    for label in reversed(host.split(".")):
        node = node.get(("h", label))
        if node is None:
            break
        best = longest_path(node, path) or best
    return best


def longest_path(node: dict, path: str) -> Rule | None:
    best, at = None, 0
    while True:
        tails = node.get("tails")
        if tails:
            rest = path[at:]
            fitting = [t for t in tails if rest.startswith(t)]
            if fitting:
                best = tails[max(fitting, key=len)]
        slash = path.find("/", at)
        node = node.get(("p", path[at:slash])) if slash >= 0 else None
        if node is None:
            return best
        at = slash + 1


def judge_urls(
    pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow", max_trie_rules: int = 100_000
) -> DataFrame:
    """`pages` with a struct column `judged` (replaced if there): host, path, rule (null without one), verdict.

    The trie is broadcast while it has at most `max_trie_rules` rules. A longer list becomes a table
    of trie nodes, and each distinct url meets the nodes on its own way down by an equi-join. A url that
    is null or has no "://" has an empty host and path and gets the default. Repeated rows are judged alike.
    """
    host, path = url_host(F.col(url)), url_path(F.col(url))
    if len(rules) > max_trie_rules:
        return judge_by_nodes(pages, rules, url, default)
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def lookup(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [longest_match(trie.value, h, p) for h, p in zip(hosts, paths, strict=True)]
        return pd.DataFrame(
            {"rule": [r and r.text for r in found], "verdict": [r.verdict if r else default for r in found]}, dtype=object
        )

    found = lookup(host, path)
    return pages.withColumn(
        "judged", F.struct(host.alias("host"), path.alias("path"), found["rule"].alias("rule"), found["verdict"].alias("verdict"))
    )


def judge_by_nodes(pages: DataFrame, rules: list[Rule], url: str, default: str) -> DataFrame:
    spark = pages.sparkSession
    split = [(r.host.translate(str.maketrans(UPPER, LOWER)), r.path[: r.path.rfind("/") + 1], r.path[r.path.rfind("/") + 1 :], r.text, r.verdict) for r in set(rules)]
    nodes = spark.createDataFrame(split, "host string, way string, tail string, rule string, verdict string")
    urls = pages.select(F.col(url).alias("u")).distinct().select("u", url_host(F.col("u")).alias("h"), url_path(F.col("u")).alias("p"))
    labels, parts = F.split("h", r"\."), F.split("p", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    # what a path begins with, up to each of its slashes, and nothing
    ways = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.concat(F.slice(parts, F.lit(1), i), F.array(F.lit(""))), "/"))
    steps = urls.withColumn("host", F.explode(suffixes)).withColumn("way", F.explode(ways))
    whole = F.concat("way", "tail")
    fits = steps.join(nodes, ["host", "way"]).filter(F.col("p").startswith(whole))
    order = F.struct(F.length("host").alias("a"), F.length(whole).alias("b"), (F.col("verdict") == "block").alias("c"))
    best = fits.groupBy("u").agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    judged = urls.join(best, ["u"], "left").select(
        F.col("u").alias("__url"),
        F.struct(
            F.col("h").alias("host"), F.col("p").alias("path"), F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        ).alias("judged"),
    )
    return pages.join(judged, F.col(url).eqNullSafe(F.col("__url")), "left").drop("__url")
