"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). Each pattern
offers its words once at no cost, and again at a cost that rises with every repetition; a min-cost
flow routes that capacity to the quotas of the sources. Documents are then selected in a seeded
order until each route is filled: what does not fit is passed over, and selection goes on until nothing
fits any more. Only totals per pattern, source and power of two of sizes reach the driver; more patterns
than `max_patterns` are an error, never another problem.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stateloom.llm.shared import free_name, kept

BUCKETS = 1 << 10
DRAWS = 1 << 40
AMPLE = 4  # a pass looks at about so many times the words it still needs


def words(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long"), F.lit(0).cast("long"))


def quotas(sizes: dict[str | None, int], weights: dict[str | None, float], share: float, limit: float) -> dict[str | None, float]:
    """`share` of all sizes split by weight; above `limit` times its size a source stops, and the excess is split again."""
    left, open_, out = share * sum(sizes.values()), {s for s in sizes if weights[s] > 0}, dict.fromkeys(sizes, 0.0)
    while open_:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / total > limit * sizes[s]}
        if not over:
            for s in open_:
                out[s] = left * weights[s] / total
            break
        for s in over:
            out[s] = float(limit * sizes[s])
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def turns(weights: list[float], sources: list[str | None]) -> dict[str | None, float]:
    """Weights dealt in turn to the sources by code point, null last."""
    ordered = sorted(sources, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    return {s: float(weights[k % len(weights)]) for k, s in enumerate(ordered)}


@dataclass
class Arc:
    to: int
    room: int
    cost: float
    back: int


class Network:
    """Successive shortest paths with potentials over integer capacities."""

    def __init__(self, nodes: int):
        self.arcs: list[list[Arc]] = [[] for _ in range(nodes)]

    def link(self, a: int, b: int, room: int, cost: float) -> Arc:
        forward = Arc(b, room, cost, len(self.arcs[b]))
        self.arcs[a].append(forward)
        self.arcs[b].append(Arc(a, 0, -cost, len(self.arcs[a]) - 1))
        return forward

    def run(self, start: int, end: int) -> None:
        potential = [0.0] * len(self.arcs)  # all costs begin at 0 or above
        while True:
            far, came = [float("inf")] * len(self.arcs), [None] * len(self.arcs)
            far[start], queue = 0.0, [(0.0, start)]
            while queue:
                d, u = heapq.heappop(queue)
                if d > far[u]:
                    continue
                for k, arc in enumerate(self.arcs[u]):
                    if arc.room > 0 and (step := d + arc.cost + potential[u] - potential[arc.to]) < far[arc.to] - 1e-9:
                        far[arc.to], came[arc.to] = step, (u, k)
                        heapq.heappush(queue, (step, arc.to))
            if came[end] is None:
                return
            potential = [p + (f if f < float("inf") else 0.0) for p, f in zip(potential, far, strict=True)]
            path, node = [], end
            while node != start:
                u, k = came[node]
                path.append(self.arcs[u][k])
                node = u
            amount = min(arc.room for arc in path)
            for arc in path:
                arc.room -= amount
                self.arcs[arc.to][arc.back].room += amount


def route(patterns: list[tuple[tuple, int]], targets: dict, repeats: int) -> dict[tuple[int, object], int]:
    """Words that pattern number p gives to source s: {(p, s): words}.

    A pattern gives its size at cost 0, a second time at cost 1, a third at cost 2 and so on, `repeats` times in all.
    """
    sources = sorted(targets, key=lambda s: (s is None, s or ""))
    at = {s: 1 + len(patterns) + k for k, s in enumerate(sources)}
    end = 1 + len(patterns) + len(sources)
    network, carried = Network(end + 1), {}
    for p, (members, size) in enumerate(patterns):
        for copy in range(repeats):
            network.link(0, 1 + p, size, float(copy))
        for s in members:
            carried[p, s] = (network.link(1 + p, at[s], repeats * size, 0.0), repeats * size)
    for s in sources:
        network.link(at[s], end, round(targets[s]), 0.0)
    network.run(0, end)
    return {key: room - arc.room for key, (arc, room) in carried.items() if room > arc.room}


def mix(
    documents: DataFrame, text: str, sources: Column, weights: list[float], share: float = 1.5, limit: int = 2,
    seed: int = 0, keys: tuple[str, ...] = ("doc_id",), max_patterns: int = 10_000,
) -> tuple[DataFrame, dict]:
    """`documents` with `size`, `pattern`, `taken` (words taken, whole copies) in a struct column; and its name (`mixed`, or
    that with underscores if taken), the sizes and the targets of the sources.

    `sources` is an array of each document's sources (a null element is a source of its own). A source's size
    counts every document in it. Documents of one pattern are taken in an order drawn from `seed`, `keys` and
    the text, copy by copy, up to what the flow asks for; a document that does not fit into what is left is passed over, until
    nothing fits. Repeated rows that also agree in all `keys` are taken alike. An empty text has size 0 and nothing
    to take, an empty table no sources. More than `max_patterns` patterns, which the driver has to hold, are refused.
    """
    name, plan_name = free_name(documents, "mixed"), free_name(documents, "mix_plan")
    drawn = F.xxhash64(F.lit(seed), *keys, text)
    members = F.array_sort(F.array_distinct(sources))
    size = words(F.col(text)).alias("size")
    rows = documents.withColumn(name, F.struct(size, members.alias("pattern"), drawn.alias("drawn")))
    table = rows.select(f"{name}.*")
    table = kept(table, "mix-sizes")
    if table.select("pattern").distinct().limit(max_patterns + 1).count() > max_patterns:
        raise ValueError(f"more than {max_patterns} combinations of sources: name fewer sources, or raise max_patterns")
    patterns = [(tuple(r["pattern"]), r["size"]) for r in table.groupBy("pattern").agg(F.sum("size").alias("size")).collect()]
    patterns.sort(key=repr)
    sizes: dict = {}
    for names, size in patterns:
        for s in names:
            sizes[s] = sizes.get(s, 0) + size
    targets = quotas(sizes, turns(weights, list(sizes)), share, limit)
    flow = route(patterns, targets, limit)
    wanted = [sum(n for (p, _), n in flow.items() if p == k) for k in range(len(patterns))]
    plan = [(list(names), *shares(want, size)) for (names, size), want in zip(patterns, wanted, strict=True)]
    spark = documents.sparkSession
    schema = "pattern array<string>, copies long, part long, sign long"
    chosen = select_part(table, spark.createDataFrame(plan, schema) if plan else spark.createDataFrame([], schema))
    chosen = chosen.select(F.struct("*").alias(plan_name))
    # a broadcast of one row per pattern, at most max_patterns of them
    found = rows.join(F.broadcast(chosen), F.col(f"{name}.pattern") == F.col(f"{plan_name}.pattern"), "left")
    mixed, planned = F.col(name), F.col(plan_name)
    extra = selected(mixed["size"], mixed["drawn"], planned["passes"], planned["fills"])
    taken = mixed["size"] * (planned["copies"] + planned["sign"] * F.coalesce(extra, F.lit(False)).cast("long"))
    struct = F.struct(mixed["size"].alias("size"), mixed["pattern"].alias("pattern"), F.coalesce(taken, F.lit(0)).alias("taken"))
    return found.select(*documents.columns, struct.alias(name)), {"column": name, "sizes": sizes, "targets": targets}


def shares(want: int, size: int) -> tuple[int, int, int]:
    """Whole copies, and the words of a partial one to add (sign 1) or, where that is less, to leave out (-1)."""
    copies, part = divmod(want, size) if size else (0, 0)
    return (copies, part, 1) if 2 * part <= size else (copies + 1, size - part, -1)


PASSES = "array<struct<salt: int, limit: long, span: long, cut: long>>"
FILLS = "array<struct<size: long, drawn: long>>"


def draw(drawn: Column, salt: Column) -> Column:
    return F.pmod(F.xxhash64(drawn, salt), F.lit(DRAWS))


def bucket(drawn: Column, salt: Column, span: Column) -> Column:
    """Which of the equal parts of a pass's span the document's draw lies in."""
    return F.floor(draw(drawn, salt) * F.lit(BUCKETS) / span)  # below 2**50, so exact enough to be the same each time


def selected(size: Column, drawn: Column, passes: Column, fills: Column) -> Column:
    """Whether a pass took the document, or a fill did."""
    taken = F.exists(
        passes, lambda p: (size <= p["limit"]) & (draw(drawn, p["salt"]) < p["span"]) & (bucket(drawn, p["salt"], p["span"]) < p["cut"])
    )
    return taken | F.array_contains(fills, F.struct(size.alias("size"), drawn.alias("drawn")))


@dataclass
class Open:
    """What a pattern's partial copy still needs, and what was taken for it."""

    pattern: list
    copies: int
    sign: int
    gap: int
    totals: dict[int, int]  # words by power of two of the documents' sizes
    passes: list[tuple[int, int, int, int]]
    fills: list[tuple[int, int]]
    filling: bool = False
    rest: tuple[tuple[int, int, int, int], int] | None = None  # a pass that takes all that is small, and its words

    def next_pass(self, salt: int) -> tuple[list, int, int, int, int, list, list]:
        """Documents up to half the gap, of which a span of the draws has a few times the words needed.

        What such a pass leaves open is less than the document at its cut, so the gap at least halves.
        """
        power = max(0, (self.gap // 2).bit_length() - 1)
        there = sum(n for k, n in self.totals.items() if k <= power)
        span = DRAWS if there <= AMPLE * self.gap else max(1, DRAWS * AMPLE * self.gap // there)
        return (self.pattern, self.gap, salt, 1 << power, span, self.passes, self.fills)


def take_passes(table: DataFrame, states: list[Open], salt: int) -> None:
    """One pass for every open pattern: the running total over buckets of the drawn order, not over documents."""
    spark = table.sparkSession
    plans = {tuple(s.pattern): s.next_pass(salt) for s in states}
    now = spark.createDataFrame(list(plans.values()), f"pattern array<string>, gap long, salt int, limit long, span long, passes {PASSES}, fills {FILLS}")
    here = table.join(F.broadcast(now), "pattern")  # a row per open pattern
    free = (F.col("size") > 0) & (F.col("size") <= F.col("limit")) & (draw(F.col("drawn"), F.col("salt")) < F.col("span"))
    free &= ~selected(F.col("size"), F.col("drawn"), F.col("passes"), F.col("fills"))
    sums = here.filter(free).groupBy("pattern", "gap", bucket(F.col("drawn"), F.col("salt"), F.col("span")).alias("bucket")).agg(F.sum("size").alias("size"))
    upto = sums.withColumn("upto", F.sum("size").over(Window.partitionBy("pattern").orderBy("bucket")))
    fits = F.col("upto") <= F.col("gap")
    cuts = upto.groupBy("pattern").agg(F.min(F.when(~fits, F.col("bucket"))).alias("cut"), F.max(F.when(fits, F.col("upto"))).alias("have"))
    found = {tuple(r["pattern"]): r for r in cuts.collect()}
    for s in states:
        _, _, _, limit, span, _, _ = plans[tuple(s.pattern)]
        row = found.get(tuple(s.pattern))
        have, cut = (row["have"] or 0, row["cut"]) if row else (0, None)
        if cut is None and span == DRAWS:  # all that is small is not enough: what is large has to come first
            s.filling, s.rest = True, ((salt, limit, span, BUCKETS), have)
        elif have:
            s.passes.append((salt, limit, span, BUCKETS if cut is None else cut))
            s.gap -= have
        else:
            s.filling = True


def take_fills(table: DataFrame, states: list[Open]) -> list[Open]:
    """The largest document that fits, for each pattern; those for which none does are done, and returned.

    Where all that is small goes in anyway, only what is larger is asked for, and the small follows when nothing larger fits.
    """
    rows = [(s.pattern, s.gap, s.rest[0][1] if s.rest else 0, s.passes, s.fills) for s in states]
    now = table.sparkSession.createDataFrame(rows, f"pattern array<string>, gap long, above long, passes {PASSES}, fills {FILLS}")
    free = (F.col("size") > F.col("above")) & (F.col("size") <= F.col("gap")) & ~selected(F.col("size"), F.col("drawn"), F.col("passes"), F.col("fills"))
    alike = table.join(F.broadcast(now), "pattern").filter(free).groupBy("pattern", "size", "drawn", "gap").agg(F.sum("size").alias("all"))
    best = alike.filter(F.col("all") <= F.col("gap")).groupBy("pattern").agg(F.max(F.struct("all", "size", "drawn")).alias("b"))
    found = {tuple(r["pattern"]): r["b"] for r in best.collect()}
    for s in states:
        if (b := found.get(tuple(s.pattern))) is not None:
            s.gap -= b["all"]
            s.fills.append((b["size"], b["drawn"]))
        elif s.rest:
            s.passes.append(s.rest[0])
            s.gap -= s.rest[1]
        s.filling, s.rest = False, None
    return [s for s in states if tuple(s.pattern) not in found]


def select_part(table: DataFrame, plan: DataFrame) -> DataFrame:
    """Per pattern: copies, sign, and the passes and single documents that make up its partial copy.

    Passes take whole buckets of documents, each pass from a drawn order of its own. When one can take nothing, or all that
    is small would not do, the largest document that fits comes, and passes go on. A pattern is done when its gap is
    closed or nothing that is left fits into it.
    """
    power = F.floor(F.log2(F.col("size"))).cast("int").alias("power")
    totals: dict = {}
    for r in table.filter("size > 0").groupBy("pattern", power).agg(F.sum("size").alias("n")).collect():
        totals.setdefault(tuple(r["pattern"]), {})[r["power"]] = r["n"]
    states = [Open(r["pattern"], r["copies"], r["sign"], r["part"], totals.get(tuple(r["pattern"]), {}), [], []) for r in plan.collect()]
    open_, salt = [s for s in states if s.gap > 0], 0
    while open_:
        closed: list[Open] = []
        if passing := [s for s in open_ if not s.filling]:
            take_passes(table, passing, salt)
            salt += 1
        if filling := [s for s in open_ if s.filling and s.gap > 0]:
            closed = take_fills(table, filling)
        open_ = [s for s in open_ if s.gap > 0 and s not in closed]
    rows = [(s.pattern, s.copies, s.sign, s.passes, s.fills) for s in states]
    return table.sparkSession.createDataFrame(rows, f"pattern array<string>, copies long, sign long, passes {PASSES}, fills {FILLS}")
