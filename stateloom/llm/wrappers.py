"""Main text of web pages by wrapper induction.

Pages become trees of block elements in which repeated neighbours are folded. The distinct trees of a
host are aligned by simple tree matching and merged into its wrapper. Every page then counts towards
the statistics of its wrapper's nodes: nodes with one text on all pages are template, nodes whose text
varies are content slots. What surrounds an article by name (menus, adverts, forms, comments) is never content.
Only trees and counts are grouped by host; pages meet the finished wrapper of their host in a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom.llm.dom import ASIDE_TAGS, Node, folded, is_aside, matching, merge, parsed, preorder, read, written
from stateloom.llm.shared import kept
from stateloom.llm.url_filter import url_host

SALTS = 16
MAIN_TAGS = ("article", "main")
CONSTANT_PAGES = 3  # so many pages of a host must agree before an equal text is template


def shape_and_blocks(page: str) -> tuple[str, list[int], list[str]]:
    """The folded tree as text, and per block, in page order, its node (in preorder) and text."""
    root, texts = read(page)
    tree, where = folded(root), [0] * len(texts)
    for number, (_, node) in enumerate(preorder(tree)):
        for block in node.blocks:
            where[block] = number
    return written(tree), where, texts


def shape_key(shape: str) -> int:
    return int.from_bytes(hashlib.blake2b(shape.encode(), digest_size=8).digest(), "big", signed=True)


def text_key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to one row per host, tree and node: pages, least and greatest text key, characters. Summed per batch."""
    for batch in batches:
        found: dict[tuple, list] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shape, where, texts = shape_and_blocks(page or "")
            by_node: dict[int, list[str]] = {}
            for node, text in zip(where, texts, strict=True):
                by_node.setdefault(node, []).append(text)
            for node, own in (by_node or {0: [""]}).items():
                key = text_key("\n".join(own))
                row = found.setdefault((host, shape, node), [0, key, key, 0])
                row[:] = row[0] + 1, min(row[1], key), max(row[2], key), row[3] + sum(map(len, own))
        keys = list(found)
        rows = list(found.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([shape_key(k[1]) for k in keys], pa.int64()),
             pa.array([k[2] for k in keys], pa.int32()), *[pa.array([r[c] for r in rows], pa.int64()) for c in range(4)]],
            names=["host", "shape", "shape_key", "node", "n", "low", "high", "size"],
        )


def merged_shapes(group: pd.DataFrame) -> pd.DataFrame:
    shapes = sorted(set(group["shape"]), key=lambda s: (-s.count("\n"), s))
    wrapper = parsed(shapes[0])
    for shape in shapes[1:]:
        wrapper = merge(wrapper, parsed(shape))
    return pd.DataFrame({"host": [group["host"].iloc[0]], "shape": [written(wrapper)]})


def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, shape_key, shape, wrapper) to the wrapper's node for each node of the shape, -1 without one."""
    for batch in batches:
        places = []
        for shape, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            tree, frame = parsed(shape), parsed(wrapper)
            number = {id(n): k for k, (_, n) in enumerate(preorder(frame))}
            partner = {id(b): number[id(a)] for a, b in matching(frame, tree)[1]}
            places.append([partner.get(id(n), -1) for _, n in preorder(tree)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.list_(pa.int32()))], names=["host", "shape_key", "places"])


def content_nodes(wrapper: Node, stats: dict[int, tuple[int, bool, int]]) -> tuple[list[int], list[int]]:
    """Numbers of the wrapper's content slots, for trees with text in an article or main element and for the others.
    `stats`: pages, whether the text varies, characters, by node.

    The first: all nodes inside these elements, less what is set aside. The others: all
    nodes that vary. If nothing varies (one page, or copies of one page), everything counts as varying.
    """
    nodes = [n for _, n in preorder(wrapper)]
    number = {id(n): k for k, n in enumerate(nodes)}

    tag = lambda n: n.label.split(".", 1)[0]
    holds_main: set[int] = set()
    for n in reversed(nodes):
        if tag(n) in MAIN_TAGS or any(id(c) in holds_main for c in n.children):
            holds_main.add(id(n))

    def inside(node: Node, in_article: bool = False) -> list[int]:
        # by class words, nothing that holds an article is set aside, except within another article (comments)
        if is_aside(node.label) and (in_article or tag(node) in ASIDE_TAGS or id(node) not in holds_main):
            return []
        within = in_article or tag(node) == "article"
        return [number[id(node)]] + [k for c in node.children for k in inside(c, within)]

    mains = [n for n in nodes if tag(n) in MAIN_TAGS]
    allowed = set(inside(wrapper))
    named = sorted({k for n in mains if number[id(n)] in allowed for k in inside(n)})
    others = allowed - set(named)
    slots = {k for k in others if k in stats and (stats[k][1] or stats[k][0] < CONSTANT_PAGES)}
    slots = slots or {k for k in others if k in stats}
    return named, sorted(slots)


def chosen_nodes(group: pd.DataFrame) -> pd.DataFrame:
    stats = {int(r.place): (int(r.n), r.low != r.high, int(r.size)) for r in group.itertuples() if r.place >= 0}
    named, varying = content_nodes(parsed(group["wrapper"].iloc[0]), stats)
    return pd.DataFrame({"host": [group["host"].iloc[0]], "named": [named], "varying": [varying]})


def induce(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, shape_key, slots): which nodes of each tree of a host hold content, from all of the host's pages."""
    rows = pages.select(url_host(F.col(url)).alias("host"), F.col(html).alias("html"))
    seen = "host string, shape string, shape_key long, node int, n long, low long, high long, size long"
    stats = rows.mapInArrow(survey, seen).groupBy("host", "shape_key", "node")
    stats = kept(stats.agg(F.first("shape").alias("shape"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("size").alias("size")), "page-nodes")
    shapes = kept(stats.groupBy("host", "shape_key").agg(F.first("shape").alias("shape")), "page-shapes")
    # a host's trees are merged in two steps, so that no task gets all trees of a large host
    salted = shapes.groupBy("host", F.pmod("shape_key", F.lit(SALTS))).applyInPandas(merged_shapes, "host string, shape string")
    wrappers = kept(salted.groupBy("host").applyInPandas(merged_shapes, "host string, shape string").withColumnRenamed("shape", "wrapper"), "page-wrappers")
    places = shapes.join(wrappers, "host").select("host", "shape_key", "shape", "wrapper")
    places = kept(places.mapInArrow(aligned, "host string, shape_key long, places array<int>"), "page-places")
    by_place = stats.join(places, ["host", "shape_key"]).withColumn("place", F.element_at("places", F.col("node") + 1)).groupBy("host", "place")
    by_place = by_place.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("size").alias("size"))
    content = by_place.join(wrappers, "host").groupBy("host").applyInPandas(chosen_nodes, "host string, named array<int>, varying array<int>")
    # each tree decides for itself: the text of a tree without text in an article is what varies
    texts = stats.filter("size > 0").groupBy("host", "shape_key").agg(F.collect_set("node").alias("with_text"))
    full = F.exists("with_text", lambda n: F.array_contains("named", F.get("places", n)))
    numbers = F.transform("places", lambda p, i: F.when(F.array_contains(F.when(full, F.col("named")).otherwise(F.col("varying")), p), i))
    places = places.join(texts, ["host", "shape_key"], "left")
    return places.join(content, "host").select("host", "shape_key", F.filter(numbers, lambda i: i.isNotNull()).alias("slots"))


def split_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, host, html) to the page's tree key and its blocks with their nodes."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            pages = [shape_and_blocks(p or "") for p in part.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array([shape_key(s) for s, _, _ in pages], pa.int64()),
                 pa.array([w for _, w, _ in pages], pa.list_(pa.int32())), pa.array([t for _, _, t in pages], pa.list_(pa.string()))],
                names=["page_id", "url", "host", "shape_key", "nodes", "texts"],
            )


def extract(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages` (page_id, url, html), with `induce`'s wrappers.

    A null or empty html gives an empty text. Pages without host share one wrapper. Repeated rows are kept.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", url_host(F.col("url")).alias("host"), "html")
    split = rows.mapInArrow(split_pages, "page_id long, url string, host string, shape_key long, nodes array<int>, texts array<string>")
    joined = split.join(wrappers, ["host", "shape_key"], "left")
    kept_texts = F.filter("texts", lambda t, i: F.array_contains("slots", F.get("nodes", i)))
    text = F.coalesce(F.array_join(kept_texts, "\n"), F.lit(""))
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
