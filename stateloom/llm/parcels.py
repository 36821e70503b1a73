"""Supersteps over the parts of a table: one task a part, and what parts tell each other travels packed, a row a letter.

A row says to which part it goes, what kind of letter it is and who wrote it, and holds columns of numbers as bytes.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ROWS = "part int, kind int, src int, data array<binary>, x long, y long"
ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("src", pa.int32()), ("data", pa.list_(pa.binary())), ("x", pa.int64()), ("y", pa.int64())])
FLUSH = 16 << 20  # bytes in a batch of letters

Letter = tuple  # (to, kind, arrays) or (to, kind, arrays, x, y): x and y are numbers that can be summed without the rest


class Post:
    """The letters that a part has got."""

    def __init__(self) -> None:
        self.kinds: dict[int, list[tuple[int, list]]] = {}

    def add(self, kind: int, src: int, data: pa.Array) -> None:
        self.kinds.setdefault(kind, []).append((src, [x.as_buffer() for x in data]))

    def letters(self, kind: int, *types: str) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Each with its writer, in the order of the writers."""
        for src, data in sorted(self.kinds.get(kind, ()), key=lambda x: x[0]):
            yield src, [np.frombuffer(b, t) for b, t in zip(data, types, strict=True)]

    def all(self, kind: int, *types: str) -> list[np.ndarray]:
        """The columns of all letters of a kind, one after the other."""
        found = [x for _, x in self.letters(kind, *types)]
        return [np.concatenate([np.empty(0, t), *(x[i] for x in found)]) if len(found) != 1 else found[0][i] for i, t in enumerate(types)]


def dealt(kind: int, to: np.ndarray, *columns: np.ndarray) -> Iterator[Letter]:
    """A letter to each part in `to` with its rows of the columns."""
    if not len(to):
        return
    order = np.argsort(to.astype(np.uint16) if to.max() < 1 << 16 else to, kind="stable")
    to, columns = to[order], [c[order] for c in columns]
    cuts = [0, *(np.flatnonzero(np.diff(to)) + 1).tolist(), len(to)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield int(to[a]), kind, [c[a:b] for c in columns]


def packed(letters: Iterable[Letter], src: int) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(ARROW)], schema=ARROW)

    for to, kind, arrays, *sums in letters:
        data = [np.ascontiguousarray(a).tobytes() for a in arrays]
        rows.append((to, kind, src, data, *(sums or (0, 0))))
        size += sum(map(len, data))
        if size > FLUSH:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def received(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, pa.Array]]:
    for part, kind, src, data in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
        yield part, kind, src, data.values


@cache
def leave_modules_alone() -> None:
    """Once a process: a Python worker collects its garbage after every task, most of the time among what its modules hold."""
    gc.collect()
    gc.freeze()


def superstep(rows: DataFrame, parts: int, step: Callable[[int, Post], Iterable[Letter]]) -> DataFrame:
    """What each part writes once it has all its letters; a part without letters writes nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_modules_alone()
        posts: dict[int, Post] = {}
        for batch in batches:
            for part, kind, src, data in received(batch):
                posts.setdefault(part, Post()).add(kind, src, data)
        for part in sorted(posts):
            yield from packed(step(part, posts.pop(part)), part)

    return rows.select(*ARROW.names).repartitionById(parts, "part").mapInArrow(run, ROWS)


def each(rows: DataFrame, step: Callable[[int, Post], Iterable[Letter]]) -> DataFrame:
    """What is written about each row by itself, where it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_modules_alone()
        for batch in batches:
            for part, kind, src, data in received(batch):
                post = Post()
                post.add(kind, src, data)
                yield from packed(step(part, post), part)

    return rows.select(*ARROW.names).mapInArrow(run, ROWS)


def order_of(*fields: tuple[np.ndarray, int]) -> np.ndarray:
    """Places in the order of whole numbers (values, bits), the first weighs most; equal ones as they came."""
    n = len(fields[0][0])
    own = max(1, (n - 1).bit_length())
    if sum(bits for _, bits in fields) + own > 64:
        return np.lexsort([values for values, _ in reversed(fields)])
    key = np.zeros(n, np.uint64)
    for values, bits in fields:  # sorting numbers is much faster than sorting places by them
        key = key << np.uint64(bits) | values.astype(np.uint64)
    key = key << np.uint64(own) | np.arange(n, dtype=np.uint64)
    key.sort()
    return (key & np.uint64((1 << own) - 1)).astype(np.int64)


def begins(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def rank_in(new: np.ndarray) -> np.ndarray:
    """Place in its run, from 0."""
    at = np.arange(len(new))
    return at - np.maximum.accumulate(np.where(new, at, 0)) if len(new) else at


def mixed(*columns: np.ndarray | int) -> np.ndarray:
    """A hash of 64 bits (SplitMix64) of whole numbers."""
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for c in columns:
            h = (h ^ np.asarray(c).astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            h = h ^ h >> np.uint64(31)
    return h


def listed(rows: DataFrame, parts: int | None, step: Callable[[int, Post], list[np.ndarray]], schema: str) -> DataFrame:
    """Plain rows (columns as arrays) that each part makes of its letters, or each row by itself if `parts` is None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_modules_alone()
        names = [c.split()[0] for c in schema.split(", ")]
        posts: dict[int, Post] = {}
        for batch in batches:
            for part, kind, src, data in received(batch):
                post = posts.setdefault(part, Post())
                post.add(kind, src, data)
                if parts is None:
                    yield pa.RecordBatch.from_arrays([*map(as_column, step(part, posts.pop(part)))], names=names)
        for part in sorted(posts):
            yield pa.RecordBatch.from_arrays([*map(as_column, step(part, posts.pop(part)))], names=names)

    rows = rows.select(*ARROW.names)
    return (rows if parts is None else rows.repartitionById(parts, "part")).mapInArrow(run, schema)


def as_column(x: np.ndarray) -> pa.Array:
    """Rows of numbers become lists."""
    if x.ndim == 1:
        return pa.array(x)
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
