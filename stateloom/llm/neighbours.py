"""Approximate nearest neighbours: an NN-descent graph and greedy search on it, both by supersteps over parts of the nodes.

Equal vectors are one node. The graph begins with the nearest nodes inside random hyperplane buckets and inside
one random group, so that no node and no small far group stays alone; then neighbours of neighbours are
compared, round after round, until few lists change. A node never gathers more than a bounded sample of its
neighbours, however many nodes point to it: what is left out stays fresh and has its turn in a later round.

Nodes lie in parts by their hash, one row a part. Edges, vectors and distances that one part has for another
travel as one packed row (`parcels`), so that Spark moves a few large rows and no edge is a row of its own.

The search is calibrated: it begins from each query's own node, its buckets and the same few nodes for all, and its
beam is doubled until a sample of the queries, compared with all nodes, has the wanted recall. In the end a beam
holds every node that can be reached.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stateloom.llm.parcels import ROWS, Letter, Post, begins, dealt, each, listed, mixed, order_of, packed, rank_in, superstep
from stateloom.llm.shared import Scratch, passing, settled

DEGREE = 24
SAMPLE = 40  # neighbours, forward and reverse, that a node brings together in a round
STOP = 0.002  # share of edges that may still change
TABLES = 8
BUCKET = 512
BEAM = 160  # nodes that a query keeps, and how many of them it opens in a step
WIDE = 40  # of BEAM; a wider beam opens as many more in a step
DOORS = 32  # nodes from which every search begins
PROBES = 64  # queries by which recall is measured
RECALL = 0.95
PART = (4096, 65536)  # nodes in a part: a sixth of all within these bounds, since each task costs a fixed tenth of a second or so
SLICE = 8192  # neighbourhoods of a part whose members meet in one task
MEMBERS = 1 << 17  # rows of buckets that a task gets at once
OPENED = 1 << 15  # nodes that the queries of a part open in a step, one a query at least
STEPS = 3  # steps of a search between two looks at what is open
CENTERS = 128  # neighbourhoods compared at once
# kinds of letters
NODES, GRAPH, MEMBER, NEAR, REVERSE, ASK, VECTORS, PAIRS, LINKS, QUERY, STATE, DOOR, ENTRY, OPEN, MEASURED = range(15)


@dataclass(frozen=True)
class Shape:
    """How nodes are numbered (part << bits | place) and brought to one scale."""

    parts: int
    bits: int
    dim: int
    kind: str  # of the vectors as given: f4 or f8
    center: np.ndarray
    scale: float
    normals: np.ndarray  # tables x planes x dim

    def numbers(self, part: int, n: int) -> np.ndarray:
        return (part << self.bits) + np.arange(n, dtype=np.int64)

    def place(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers & ((1 << self.bits) - 1)).astype(np.int32)

    def part(self, numbers: np.ndarray) -> np.ndarray:
        return numbers >> self.bits

    @property
    def slices(self) -> int:
        return max(1, (1 << self.bits - 1) // SLICE)

    @property
    def width(self) -> int:
        """Bits of a number."""
        return self.bits + self.parts.bit_length()

    @property
    def link(self) -> str:
        return "i4" if self.width < 32 else "i8"

    def nodes(self, post: Post) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and vectors."""
        names, x = post.all(NODES, "i8", self.kind)
        return names, x.reshape(-1, self.dim)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.center) / self.scale).astype(np.float32)

    def buckets(self, z: np.ndarray, names: np.ndarray) -> np.ndarray:
        """The side of each random plane on which a vector lies, one bucket number per table, and a random one."""
        tables, planes, _ = self.normals.shape
        codes = [(z @ n.T > 0) @ (1 << np.arange(planes)) if planes else np.zeros(len(z), np.int64) for n in self.normals.astype(np.float32)]
        codes.append(names.view(np.uint64) >> np.uint64(16) & np.uint64((1 << planes) - 1))  # nodes are hashes
        return np.stack([c.astype(np.int64) * (tables + 1) + t for t, c in enumerate(codes)], 1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """key and vec (array<float> if given so, else array<double>) of the rows that take part.

    Left out: null keys, and vectors that are null, zero, hold null or non-finite components, or whose length is not the
    most frequent one (of equally frequent ones the smallest).
    """
    vec = F.col(vector) if dict(vectors.dtypes).get(vector) == "array<float>" else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("key"), vec.alias("vec")).filter("key is not null and vec is not null and size(vec) > 0")
    rows = rows.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.col("count").desc(), "size").first()
    return rows.filter(F.size("vec") == (sizes["size"] if sizes else 0))


def smallest_keys(rows: DataFrame, most: int) -> DataFrame:
    """node and the `most` smallest keys of each distinct vector (repeated rows count once)."""
    order = Window.partitionBy("node").orderBy("key")
    ranked = rows.select("node", "key").distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    return ranked.groupBy("node").agg(F.array_sort(F.collect_list("key")).alias("keys"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as rows of numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), flat.dtype)


def nodes_by_part(rows: DataFrame, parts: int, bits: int, dim: int, kind: str) -> DataFrame:
    """A letter of all distinct nodes a part, hashes ascending; x is their number."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, first = np.unique(batch.column(0).to_numpy(), return_index=True)
            yield from packed(dealt(NODES, (names.view(np.uint64) % np.uint64(parts)).astype(np.int64), names, matrix(batch.column(1))[first]), 0)

    def gather(part: int, post: Post) -> Iterator[Letter]:
        names, x = post.all(NODES, "i8", kind)
        names, first = np.unique(names, return_index=True)
        if len(names) > 1 << bits:
            raise ValueError(f"{len(names)} nodes in a part for {1 << bits}")
        yield part, NODES, [names, x.reshape(-1, dim)[first]], len(names), 0

    return superstep(rows.select("node", "vec").mapInArrow(send, ROWS), parts, gather)


def shape_of(nodes: DataFrame, count: int, parts: int, bits: int, dim: int, kind: str, seed: int) -> Shape:
    """One partial sum per part reaches the driver."""

    def partial(part: int, post: Post) -> list[np.ndarray]:
        _, x = post.all(NODES, "i8", kind)
        x = x.reshape(-1, dim).astype(float)
        return [np.array([len(x)]), (x / len(x)).sum(0)[None], np.abs(x).max()[None]]

    got = listed(nodes, None, partial, "n long, mean array<double>, most double").collect()
    center = np.sum([np.array(g["mean"]) * (g["n"] / count) for g in got], 0)
    planes = max(0, int(np.ceil(np.log2(max(1, count / BUCKET)))))
    normals = np.random.default_rng(seed).standard_normal((TABLES, planes, dim))
    return Shape(parts, bits, dim, kind, center, max(max(g["most"] for g in got) + float(np.abs(center).max()), 1e-300), normals)


def squares(z: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a matrix (or of each matrix of a stack) with all; z is taken relative to its first row."""
    z = z - z[..., :1, :]  # products lose digits far from the origin
    products = z @ np.swapaxes(z, -1, -2)
    s = np.diagonal(products, axis1=-2, axis2=-1)
    return np.maximum(s[..., :, None] + s[..., None, :] - 2 * products, 0)


def merged(near: np.ndarray, d: np.ndarray, old: np.ndarray, u: np.ndarray, v: np.ndarray, dist: np.ndarray, degree: int, width: int) -> tuple:
    """The `degree` nearest of each row's list and of what was found for it (row u: v at dist), nearest first; -1 fills up.

    A node that is met again keeps its mark in `old`. Distances that differ by less than a millionth may change places.
    """
    n, have = len(near), near >= 0
    row = np.repeat(np.arange(n), have.sum(1))
    u, v, dist = (np.concatenate(x) for x in ((row, u), (near[have], v), (d[have], dist)))
    was, new = np.concatenate([old[have], np.zeros(len(u) - len(row), bool)]), np.arange(len(u)) >= len(row)
    out = np.full((n, degree), -1, np.int64), np.full((n, degree), np.inf, d.dtype), np.zeros((n, degree), bool)
    if not len(u):
        return out
    order = order_of((u, n.bit_length()), (v, width), (new, 1))
    u, v, dist, was = u[order], v[order], dist[order], was[order]
    start = np.flatnonzero(begins(u, v))
    u, v, dist, was = u[start], v[start], np.minimum.reduceat(dist, start), was[start]
    with np.errstate(over="ignore"):
        order = order_of((u, n.bit_length()), (np.abs(dist).astype(np.float32).view(np.uint32) >> np.uint32(4), 27))
    rank = rank_in(begins(u[order]))
    order, rank = order[rank < degree], rank[rank < degree]
    for to, x in zip(out, (v, dist, was), strict=True):
        to[u[order], rank] = x[order]
    return out


def graph_of(post: Post, degree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """near, squared distances, and which edges are old; a row a node."""
    return tuple(x.reshape(-1, degree) for x in post.all(GRAPH, "i8", "f4", "?"))


def first_graph(nodes: DataFrame, shape: Shape, count: int, degree: int) -> Scratch:
    """The nearest nodes among those of one bucket, which is split by hash where it is large."""
    tables = TABLES + 1 if shape.normals.shape[1] else 1  # without planes all are one bucket

    def crowd(part: int, post: Post) -> list[np.ndarray]:
        names, x = shape.nodes(post)
        return [*np.unique(shape.buckets(shape.scaled(x), names)[:, :tables], return_counts=True)]

    counts = listed(nodes, None, crowd, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") > 2 * BUCKET)
    large = counts.orderBy("bucket").collect()
    large, pieces = np.array([r["bucket"] for r in large], np.int64), np.array([-(-r["n"] // (2 * BUCKET)) for r in large], np.int64)

    def empty(part: int, post: Post) -> Iterator[Letter]:
        n = len(shape.nodes(post)[0])
        yield part, GRAPH, [np.full((n, degree), -1, np.int64), np.full((n, degree), np.inf, np.float32), np.zeros((n, degree), bool)]

    def send(some: range):
        def members(part: int, post: Post) -> Iterator[Letter]:
            names, x = shape.nodes(post)
            z, numbers = shape.scaled(x), shape.numbers(part, len(x))
            buckets = shape.buckets(z, names)
            for t in some:
                bucket, salt = buckets[:, t], np.zeros(len(x), np.int64)
                if len(large):
                    at = np.minimum(np.searchsorted(large, bucket), len(large) - 1)
                    salt = np.where(large[at] == bucket, (mixed(names, bucket) % pieces[at].astype(np.uint64)).astype(np.int64), 0)
                group = bucket << 24 | salt
                yield from dealt(MEMBER, (mixed(group) % np.uint64(shape.parts)).astype(np.int64), group, numbers, z)

        return members

    def inside(part: int, post: Post) -> Iterator[Letter]:
        group, numbers, z = post.all(MEMBER, "i8", "i8", "f4")
        order = np.lexsort((numbers, group))
        group, numbers, z = group[order], numbers[order], z.reshape(-1, shape.dim)[order]
        cuts = [*np.flatnonzero(begins(group)).tolist(), len(group)]
        near, dist = np.full((len(group), degree), -1, np.int64), np.full((len(group), degree), np.inf, np.float32)
        for a, b in zip(cuts, cuts[1:], strict=False):
            m, most = b - a, min(degree, b - a - 1)
            if most < 1:
                continue
            d = squares(z[a:b] - z[a:b].mean(0))
            np.fill_diagonal(d, np.inf)
            low = np.int32((1 << (m - 1).bit_length()) - 1)  # the lowest digits give way to the place: whole numbers are sorted fast
            key = np.partition(d.view(np.int32) & ~low | np.arange(m, dtype=np.int32), most - 1, axis=1)[:, :most]
            at = key & low
            near[a:b, :most], dist[a:b, :most] = numbers[a:b][at], np.take_along_axis(d, at, 1)
        yield from dealt(NEAR, shape.part(numbers), shape.place(numbers), near, dist)

    def gather(part: int, post: Post) -> Iterator[Letter]:
        place, v, dist = post.all(NEAR, "i4", "i8", "f4")
        u, there = np.repeat(place.astype(np.int64), degree), v >= 0
        yield part, GRAPH, merged(*graph_of(post, degree), u[there], v[there], dist[there], degree, shape.width)

    at_once, graph, table = max(1, min(tables, MEMBERS * shape.parts // count)), each(nodes, empty), None
    for t in range(0, tables, at_once):
        members = superstep(each(nodes, send(range(t, min(tables, t + at_once)))), shape.parts, inside)
        done, table = table, passing(superstep(members.union(graph), shape.parts, gather), "graph")
        graph = table.rows
        if done:
            done.drop()
    return table


def told(shape: Shape, degree: int, most: int, by_distance: bool):
    """Each part's edges are told to the parts they lead to, at most `most` a node, the nearest or the fresh first."""

    def tell(part: int, post: Post) -> Iterator[Letter]:
        near, d, old = graph_of(post, degree)
        have = near >= 0
        c, m, dist, fresh = np.repeat(shape.numbers(part, len(near)), have.sum(1)), near[have], d[have], ~old[have]
        if len(m):
            first = (dist.view(np.uint32) >> np.uint32(16), 16) if by_distance else (~fresh, 1)
            order = order_of((m, shape.width), first, (mixed(c, m) & np.uint64(0xFF), 8))
            order = order[rank_in(begins(m[order])) < most]
            m, c = m[order], c[order]
            yield from dealt(REVERSE, shape.part(m), shape.place(m), c, dist[order], fresh[order])
        yield part, GRAPH, [near, d, old]

    return tell


def sampled(shape: Shape, degree: int, sample: int):
    """Each node chooses neighbours in both directions, at most `sample`, new edges first, and asks for their vectors.

    An edge is old once it has been in a sample. Where nothing is new nothing is asked.
    """

    def choose(part: int, post: Post) -> Iterator[Letter]:
        near, d, old = graph_of(post, degree)
        old, n, have = old.copy(), len(near), near >= 0
        place, whom, _, fresh = post.all(REVERSE, "i4", "i8", "f4", "?")
        c = np.concatenate([np.repeat(np.arange(n), have.sum(1)), place])
        m, fresh = np.concatenate([near[have], whom]), np.concatenate([~old[have], fresh])
        if len(c):
            order = order_of((c, n.bit_length()), (m, shape.width), (~fresh, 1))
            c, m, fresh = c[order], m[order], fresh[order]
            new = begins(c, m)
            pair = np.empty(len(c), np.int64)
            pair[order] = np.cumsum(new) - 1
            c, m, fresh = c[new], m[new], fresh[new]
            order = order_of((c, n.bit_length()), (~fresh, 1), (mixed(m, c) & np.uint64(0xFFFF), 16))
            order = order[rank_in(begins(c[order])) < sample]
            met = np.zeros(len(c), bool)
            met[order] = True
            old[have] |= met[pair[: have.sum()]]
            c, m, fresh = c[order], m[order], fresh[order]
            new = np.zeros(n, bool)
            new[c[fresh]] = True
            c, m, fresh = c[new[c]], m[new[c]], fresh[new[c]]
            yield from dealt(ASK, shape.part(m), shape.place(m), c.astype(np.int32), fresh)
        yield part, GRAPH, [near, d, old]

    return choose


def answered(shape: Shape, degree: int):
    """A part sends each vector once to each part that asks for it, with the distance beyond which its node has no use for others."""

    def answer(part: int, post: Post) -> Iterator[Letter]:
        near, d, old = graph_of(post, degree)
        worst, z, numbers = d[:, -1], shape.scaled(shape.nodes(post)[1]), shape.numbers(part, len(near))
        for src, letter in post.letters(ASK, "i4", "i4", "?"):
            for s in range(shape.slices):
                place, c, fresh = (x[letter[1] % shape.slices == s] for x in letter)
                asked, at = np.unique(place, return_inverse=True)
                if len(asked):
                    yield src * shape.slices + s, VECTORS, [numbers[asked], worst[asked], z[asked]]
                    yield src * shape.slices + s, PAIRS, [c, at.astype(np.int32), fresh]
        yield part * shape.slices, GRAPH, [near, d, old]

    return answer


def introduced(shape: Shape):
    """What members of one neighbourhood learn of each other, where it is nearer than what they have; a slice of a part a task."""

    def meet(part: int, post: Post) -> Iterator[Letter]:
        vectors = [*post.letters(VECTORS, "i8", "f4", "f4")]
        starts = np.cumsum([0, *(len(x[0]) for _, x in vectors)])
        pairs = [(c, at.astype(np.int64) + start, fresh) for (_, (c, at, fresh)), start in zip(post.letters(PAIRS, "i4", "i4", "?"), starts, strict=False)]
        if pairs:
            numbers, worst, z = (np.concatenate([x[i] for _, x in vectors]) for i in range(3))
            z, own = z.reshape(-1, shape.dim), len(numbers)
            c, at, fresh = (np.concatenate(x) for x in zip(*pairs, strict=True))
            order = order_of((c, shape.bits), (at, own.bit_length()))
            c, at, fresh = c[order], at[order], fresh[order]
            new = begins(c)
            row, rank = np.cumsum(new) - 1, rank_in(new)
            members, is_new = np.full((row[-1] + 1, rank.max() + 1), -1, np.int64), np.zeros((row[-1] + 1, rank.max() + 1), bool)
            members[row, rank], is_new[row, rank] = at, fresh
            keys, far = [], []
            for a in range(0, len(members), CENTERS):
                who, f = members[a : a + CENTERS], is_new[a : a + CENTERS]
                dist = squares(z[who])
                wanted = dist < np.where(who >= 0, worst[who], -1)[:, :, None]
                wanted &= f[:, :, None] | f[:, None, :]
                wanted &= (who >= 0)[:, None, :]
                wanted[:, np.arange(who.shape[1]), np.arange(who.shape[1])] = False
                hit = np.flatnonzero(wanted)
                i, j = np.divmod(hit, who.shape[1])  # i: center and row
                u, v = who.ravel()[i], who[i // who.shape[1], j]
                keys.append(u * own + v)
                far.append(dist.ravel()[hit])
            keys, far = np.concatenate(keys), np.concatenate(far)
            if len(keys):
                order = order_of((keys, (own * own).bit_length()))
                keys, far = keys[order], far[order]
                start = np.flatnonzero(begins(keys))
                u, v = np.divmod(keys[start], own)
                u, v, far = numbers[u], numbers[v], np.minimum.reduceat(far, start)
                yield from dealt(NEAR, shape.part(u), shape.place(u), v, far)
        for _, graph in post.letters(GRAPH, "i8", "f4", "?"):
            yield part // shape.slices, GRAPH, graph

    return meet


def improved(shape: Shape, degree: int):
    def gather(part: int, post: Post) -> Iterator[Letter]:
        place, v, dist = post.all(NEAR, "i4", "i8", "f4")
        near, d, old = merged(*graph_of(post, degree), place.astype(np.int64), v, dist, degree, shape.width)
        yield part, GRAPH, [near, d, old], int(((near >= 0) & ~old).sum()), int((near >= 0).sum())

    return gather


def build_graph(nodes: DataFrame, shape: Shape, count: int, degree: int = DEGREE, sample: int = SAMPLE, stop: float = STOP) -> Scratch:
    """Each part's lists, by NN-descent until no more than a `stop` share of edges is fresh.

    An edge that has been in a sample is fresh no more, and distances only fall, so that fresh edges run out.
    """
    table, nodes = first_graph(nodes, shape, count, degree), nodes.coalesce(max(1, shape.parts // 3))
    while True:
        asked = superstep(each(table.rows, told(shape, degree, sample, False)), shape.parts, sampled(shape, degree, sample))
        met = superstep(superstep(asked.union(nodes), shape.parts, answered(shape, degree)), shape.parts * shape.slices, introduced(shape))
        done, table = table, passing(superstep(met, shape.parts, improved(shape, degree)), "graph")
        done.drop()
        fresh = table.rows.agg(F.sum("x"), F.sum("y")).first()
        if not fresh[1] or fresh[0] <= stop * fresh[1]:
            return table


def both_ways(graph: DataFrame, shape: Shape, degree: int, most: int) -> DataFrame:
    """Neighbours and the nearest of those that have the node as theirs, at most `most` in all."""

    def link(part: int, post: Post) -> Iterator[Letter]:
        near, d, old = graph_of(post, degree)
        place, whom, dist, _ = post.all(REVERSE, "i4", "i8", "f4", "?")
        yield part, LINKS, [merged(near, d, old, place.astype(np.int64), whom, dist, most, shape.width)[0].astype(shape.link)]

    return superstep(each(graph, told(shape, degree, most, True)), shape.parts, link)


def asked_of(kind: int, shape: Shape, q: np.ndarray, n: np.ndarray, known: np.ndarray, vectors: np.ndarray, bounds: np.ndarray) -> Iterator[Letter]:
    """(query, node) pairs to the parts of the nodes, each query's vector and bound once a part; `known` are the queries, ascending."""
    part = shape.part(n)
    yield from dealt(kind, part, shape.place(n), q)
    at = np.searchsorted(known, q)
    to, at = np.divmod(np.unique(part * len(known) + at), max(1, len(known)))
    yield from dealt(VECTORS, to, known[at], vectors[at], bounds[at])


def queries_in(shape: Shape, post: Post) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, vectors and bounds of the queries that letters bring, ascending."""
    known, vectors, bounds = post.all(VECTORS, "i8", shape.kind, "f8")
    known, first = np.unique(known, return_index=True)
    return known, vectors.reshape(-1, shape.dim)[first], bounds[first]


def bounds_of(n: np.ndarray, d: np.ndarray, most: int) -> np.ndarray:
    """Beyond what distance a node can't be among a query's `most` nearest any more; lists are in order but for the last digits."""
    return d[:, most - 1] * (1 + 1e-5) if d.shape[1] >= most else np.full(len(n), np.inf)


def state_of(shape: Shape, post: Post) -> list[np.ndarray]:
    """Of a part's queries: numbers ascending, hashes, vectors; nodes found, nearest first, their distances, and which are open."""
    q, names, vec, n, d, opened = post.all(STATE, "i8", "i8", shape.kind, "i8", "f8", "?")
    return [q, names, vec.reshape(-1, shape.dim), *(x.reshape(len(q), -1) if len(q) else x.reshape(0, 0) for x in (n, d, opened))]


def with_measured(shape: Shape, post: Post, beam: int) -> list[np.ndarray]:
    """The state with what has been measured, twice `beam` nodes."""
    q, names, vec, *lists = state_of(shape, post)
    of, n, d = post.all(MEASURED, "i8", "i8", "f8")
    return [q, names, vec, *merged(*lists, np.searchsorted(q, of), n, d, 2 * beam, shape.width)]


def opening(shape: Shape, beam: int, wide: int, measured: bool):
    """Each query opens the `wide` nearest of its `beam` nearest nodes that are not open yet."""

    def turn(part: int, post: Post) -> Iterator[Letter]:
        q, names, vec, n, d, opened = with_measured(shape, post, beam) if measured else state_of(shape, post)
        if len(q):
            closed = (n >= 0) & ~opened
            closed[:, beam:] = False
            now = closed & (np.cumsum(closed, 1) <= max(1, min(wide, OPENED // len(q))))
            row = np.nonzero(now)[0]
            yield part, STATE, [q, names, vec, n, d, opened | now]
            yield from asked_of(OPEN, shape, q[row], n[now], q, vec, bounds_of(n, d, 2 * beam))

    return turn


def reaching(shape: Shape, most: int):
    """The neighbours of opened nodes, once a query and part."""

    def reach(part: int, post: Post) -> Iterator[Letter]:
        links, queries = post.all(LINKS, shape.link)[0].reshape(-1, most), queries_in(shape, post)
        place, q = post.all(OPEN, "i4", "i8")
        near = links[place].astype(np.int64)
        have = near >= 0
        at, n = np.repeat(np.searchsorted(queries[0], q), have.sum(1)), near[have]
        if len(n):
            order = order_of((at, len(queries[0]).bit_length()), (n, shape.width))
            order = order[begins(at[order], n[order])]
            yield from asked_of(ASK, shape, queries[0][at[order]], n[order], *queries)
        yield from passed_on(part, post, shape)

    return reach


def passed_on(part: int, post: Post, shape: Shape) -> Iterator[Letter]:
    for _, state in post.letters(STATE, "i8", "i8", shape.kind, "i8", "f8", "?"):
        yield part, STATE, state


def measuring(shape: Shape):
    """Distances from queries to nodes, by differences; what lies beyond a query's bound is not sent back."""

    def measure(part: int, post: Post) -> Iterator[Letter]:
        known, vectors, bounds = queries_in(shape, post)
        place, q = post.all(ASK, "i4", "i8")
        if len(q):
            x = shape.nodes(post)[1]
            at = np.searchsorted(known, q)
            order = order_of((at, len(known).bit_length()), (place, shape.bits + 1))
            order = order[begins(at[order], place[order])]
            at, place, d = at[order], place[order], np.empty(len(order))
            for a in range(0, len(d), 4096):
                here = slice(a, a + 4096)
                d[here] = np.sqrt(((x[place[here]].astype(float) - vectors[at[here]].astype(float)) ** 2).sum(1))
            near = d <= bounds[at]
            at, place, d = at[near], place[near], d[near]
            yield from dealt(MEASURED, shape.part(known[at]), known[at], shape.numbers(part, len(x))[place], d)
        yield from passed_on(part, post, shape)

    return measure


def looked(shape: Shape, beam: int):
    """The state after a number of steps; x counts what is still to open."""

    def look(part: int, post: Post) -> Iterator[Letter]:
        state = with_measured(shape, post, beam)
        if len(state[0]):
            yield part, STATE, state, int(((state[3] >= 0) & ~state[5])[:, :beam].sum()), len(state[0])

    return look


def search(shape: Shape, state: Scratch, links: DataFrame, nodes: DataFrame, beam: int = BEAM, wide: int = WIDE) -> Scratch:
    """The nearest nodes found for each query, twice `beam` of them, by greedy search from `state`.

    In every step each query opens the `wide` nearest of its `beam` nearest nodes that are not open yet and their parts
    measure the neighbours; it ends when the nearest of no query lead anywhere new. What lies beyond the beam is kept for a
    wider one.
    """
    few = max(1, shape.parts // 3)  # tasks that only read
    links, nodes = links.coalesce(few), nodes.coalesce(few)
    while True:  # a node is opened once, so this ends
        rows = each(state.rows, opening(shape, beam, wide, False))
        for step in range(STEPS):
            if step:
                rows = superstep(rows, shape.parts, opening(shape, beam, wide, True))
            reached = superstep(rows.union(links), shape.parts, reaching(shape, 2 * DEGREE))
            rows = superstep(reached.union(nodes), shape.parts, measuring(shape))
        done, state = state, passing(superstep(rows, shape.parts, looked(shape, beam)), "search")
        done.drop()
        if not state.rows.agg(F.sum("x")).first()[0]:
            return state


def entered(asked: DataFrame, nodes: DataFrame, shape: Shape, least: int) -> Scratch:
    """The state in which a search begins: each query at its own node, at four nodes of each of its buckets and at the same few for all."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_numpy()
            yield from packed(dealt(QUERY, (names.view(np.uint64) % np.uint64(shape.parts)).astype(np.int64), names), 0)

    def doors(part: int, post: Post) -> list[np.ndarray]:
        names, _ = shape.nodes(post)
        order = mixed(names, 2)
        first = np.argsort(order, kind="stable")[:least]
        return [order[first].view(np.int64), shape.numbers(part, len(names))[first]]

    chosen = listed(nodes, None, doors, "turn long, node long").orderBy("turn", "node").limit(least).collect()
    everywhere = np.array([r["node"] for r in chosen], np.int64)

    def begin(part: int, post: Post) -> Iterator[Letter]:
        names, x = shape.nodes(post)
        buckets, numbers = shape.buckets(shape.scaled(x), names), shape.numbers(part, len(x))
        bucket, node, turn = buckets.T.ravel(), np.tile(numbers, buckets.shape[1]), np.tile(mixed(names) >> np.uint64(1), buckets.shape[1])
        order = np.lexsort((turn, bucket))
        order = order[rank_in(begins(bucket[order])) < 4]
        yield from dealt(DOOR, (mixed(bucket[order]) % np.uint64(shape.parts)).astype(np.int64), bucket[order], turn[order], node[order])
        place = np.searchsorted(names, np.unique(post.all(QUERY, "i8")[0]))
        if len(place):
            none = np.empty((len(place), 0))
            yield part, STATE, [numbers[place], names[place], x[place], none.astype(np.int64), none, none.astype(bool)]
            bucket, q = buckets[place].ravel(), np.repeat(numbers[place], buckets.shape[1])
            yield from dealt(QUERY, (mixed(bucket) % np.uint64(shape.parts)).astype(np.int64), bucket, q)

    def pair(part: int, post: Post) -> Iterator[Letter]:
        bucket, turn, node = post.all(DOOR, "i8", "u8", "i8")
        order = np.lexsort((node, turn, bucket))
        rank = rank_in(begins(bucket[order]))
        bucket, node = bucket[order[rank < 4]], node[order[rank < 4]]
        of, q = post.all(QUERY, "i8", "i8")
        for i in range(4):
            at = np.searchsorted(bucket, of) + i
            there = at < len(bucket)
            there[there] = bucket[at[there]] == of[there]
            yield from dealt(ENTRY, shape.part(q[there]), q[there], node[at[there]])
        yield from passed_on(part, post, shape)

    def enter(part: int, post: Post) -> Iterator[Letter]:
        q, _, vec, *_ = state_of(shape, post)
        if len(q):
            of, n = post.all(ENTRY, "i8", "i8")
            of = np.concatenate([of, q, np.repeat(q, len(everywhere))])
            yield from asked_of(ASK, shape, of, np.concatenate([n, q, np.tile(everywhere, len(q))]), q, vec, np.full(len(q), np.inf))
        yield from passed_on(part, post, shape)

    rows = superstep(asked.select("query").distinct().mapInArrow(send, ROWS).union(nodes), shape.parts, begin)
    rows = superstep(superstep(rows, shape.parts, pair), shape.parts, enter)
    return passing(superstep(superstep(rows.union(nodes), shape.parts, measuring(shape)), shape.parts, looked(shape, BEAM)), "search")


def found_by(state: DataFrame, nodes: DataFrame, shape: Shape, most: int) -> DataFrame:
    """(query, n, d), both by hash: the `most` nearest nodes of each query, and what is as near as the last."""

    def send(part: int, post: Post) -> Iterator[Letter]:
        _, names, _, n, d, _ = state_of(shape, post)
        bound = np.partition(d, most - 1, axis=1)[:, most - 1] if d.shape[1] >= most else np.full(len(d), np.inf)
        near = (n >= 0) & (d <= bound[:, None])
        yield from dealt(MEASURED, shape.part(n[near]), shape.place(n[near]), np.repeat(names, near.sum(1)), d[near])

    def name(part: int, post: Post) -> list[np.ndarray]:
        place, q, d = post.all(MEASURED, "i4", "i8", "f8")
        return [q, shape.nodes(post)[0][place], d]

    return listed(each(state, send).union(nodes), shape.parts, name, "query long, n long, d double")


def exact_nearest(nodes: DataFrame, shape: Shape, names: np.ndarray, x: np.ndarray, k: int) -> DataFrame:
    """(query, d): distance of the k-th nearest other node of each probe, by comparing the probes with all nodes.

    A task keeps k distances for each probe.
    """

    def run(part: int, post: Post) -> list[np.ndarray]:
        others, y = shape.nodes(post)
        y, best = y.astype(float), np.full((len(x), k), np.inf)
        for i in range(len(x)):
            d = np.sqrt(((y - x[i]) ** 2).sum(1))[others != names[i]]
            best[i, : len(d)] = np.sort(np.partition(d, k)[:k] if len(d) > k else d)
        at = np.isfinite(best)
        return [np.repeat(names, at.sum(1)), best[at]]

    rows = listed(nodes, None, run, "query long, d double")
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("d"))).filter(F.col("place") <= k)
    return ranked.groupBy("query").agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("wanted"))


def recall_of(found: DataFrame, bounds: DataFrame) -> float:
    """Share of the probes' nearest nodes that a search has found; nodes at the same distance stand for each other."""
    near = found.select("query", "n", F.col("d").alias("found")).join(bounds, "query").filter((F.col("n") != F.col("query")) & (F.col("found") <= F.col("d") * (1 + 1e-9)))
    hits = near.groupBy("query", "wanted").agg(F.count(F.lit(1)).alias("hits")).agg(F.sum(F.least("hits", "wanted"))).first()[0]
    wanted = bounds.agg(F.sum("wanted")).first()[0]
    return (hits or 0) / wanted if wanted else 1.0


def calibrated_search(state: Scratch, graph: DataFrame, nodes: DataFrame, shape: Shape, count: int, k: int, degree: int, recall: float = RECALL) -> DataFrame:
    """`search` with a beam that doubles until the probes' recall is as wanted, or the beam has room for all nodes."""

    def probing(part: int, post: Post) -> list[np.ndarray]:
        _, names, vec, *_ = state_of(shape, post)
        order = mixed(names, 1)
        first = np.argsort(order, kind="stable")[:PROBES]
        return [order[first].view(np.int64), names[first], vec[first].astype(float)]

    links, beam = settled(both_ways(graph, shape, degree, 2 * DEGREE), "graph-links"), BEAM
    probes = listed(state.rows, None, probing, "turn long, query long, vec array<double>").orderBy("turn", "query").limit(PROBES).collect()
    state = search(shape, state, links, nodes, beam)
    found = settled(found_by(state.rows, nodes, shape, k + 1), "found")
    if not probes:
        return found
    names = np.array([p["query"] for p in probes], np.int64)
    bounds = settled(exact_nearest(nodes, shape, names, np.array([p["vec"] for p in probes], float), k), "probes")
    while beam < count and recall_of(found, bounds) < recall:
        beam *= 2  # goes on from what was found and opened
        state = search(shape, state, links, nodes, beam, WIDE * (beam // BEAM))
        found = settled(found_by(state.rows, nodes, shape, k + 1), "found")
    return found


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10, degree: int = DEGREE, seed: int = 7
) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` nearest other rows found for each row where `is_query` (over `key`).

    Every usable row is in the index. Copies of a vector are at distance 0 of each other; a row repeated with its key
    counts once. Fewer than `k` other rows give fewer results, an empty table none; else every query has `k`, since each
    search has more than `k` nodes to begin with.
    """
    rows = settled(usable(vectors, key, vector).withColumn("node", F.xxhash64("vec")), "vectors")
    asked = rows.filter(is_query).select(F.col("key").alias("query_id"), F.col("node").alias("query")).distinct()
    head = rows.select(F.size("vec").alias("dim")).first()
    if head is None:
        return asked.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, kind, total = head["dim"], "f4" if dict(rows.dtypes)["vec"] == "array<float>" else "f8", rows.count()
    size = min(max(-(-total // 6), PART[0]), PART[1])
    parts, bits = -(-total // size), (2 * size).bit_length()
    # queries of one vector are one search, which begins at the vector itself and at a few nodes of its buckets
    nodes = settled(nodes_by_part(rows, parts, bits, dim, kind), "nodes")
    count = nodes.agg(F.sum("x")).first()[0]
    shape = shape_of(nodes, count, parts, bits, dim, kind, seed)
    graph = build_graph(nodes, shape, count, degree)
    state = entered(asked, nodes, shape, max(DOORS, k + 1))
    found = calibrated_search(state, graph.rows, nodes, shape, count, k, degree)
    found = found.join(smallest_keys(rows, k + 1).withColumnRenamed("node", "n"), "n").join(asked, "query")
    found = found.select("query_id", F.col("d").alias("score"), F.explode("keys").alias("vec_id")).filter("vec_id <> query_id")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
