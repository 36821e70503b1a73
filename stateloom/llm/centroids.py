"""Exact integer k-means, in which most centroids are ruled out by means and deviations.

A vector of n components with mean m and deviation v (root of the summed squares around the mean) and a
centroid with M and V are at least n * (m - M)^2 + (v - V)^2 apart, squared. So centroids are held in
the order of their means; a vector starts at the mean next to its own and goes outward both ways. A
direction ends at the first centroid whose mean alone is too far off, a centroid is passed over if mean
and deviation together are, and what is left is measured in integers. Both tests only rule out what is
strictly farther than the best so far, so that ties reach the integers and go to the smaller number.

Vectors that are null, of another length than `dimensions`, or that hold a null or non-finite component
take no part and are not in the result. Repeated rows count as often as they stand; null ids are
allowed and come last where seeds are drawn. With fewer vectors than `k` there are as many centroids as
vectors; an empty table gives an empty result. Components whose integers pass LARGEST in size end the
run with an error, since squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.llm.shared import settled

LARGEST = 1 << 26  # 512 components may then differ by twice that, and the squares still fit a long
MOST_DIMENSIONS = 512
MOST_CENTROIDS = 65_536  # with their components they go to every task and come back as sums
ROUNDING = 1e-9  # of float bounds, relative


@dataclass(frozen=True)
class Options:
    k: int = 8
    rounds: int = 10
    scale: int = 1024
    dimensions: int = 64
    salt: str = "3:"

    def __post_init__(self):
        if not 0 < self.k <= MOST_CENTROIDS or not 0 < self.dimensions <= MOST_DIMENSIONS or self.rounds < 0:
            raise ValueError("k, dimensions or rounds out of range")


class Ordered:
    """Centroids in the order of their means, with what the two inequalities need."""

    def __init__(self, centroids: np.ndarray):
        n = centroids.shape[1]
        self.number = np.argsort(centroids.sum(axis=1), kind="stable")
        self.points = centroids[self.number]
        self.mean, self.deviation = mean_and_deviation(self.points)
        self.n = n

    def __len__(self) -> int:
        return len(self.number)


def mean_and_deviation(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    as_float = rows.astype(np.float64)
    mean = as_float.mean(axis=1)
    return mean, np.sqrt(((as_float - mean[:, None]) ** 2).sum(axis=1))


def nearest(vectors: np.ndarray, ordered: Ordered) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid and squared distance of each row, and how many distances were measured."""
    rows, k = len(vectors), len(ordered)
    best = np.full(rows, np.iinfo(np.int64).max)
    winner = np.full(rows, k, np.int64)
    mean, deviation = mean_and_deviation(vectors)
    # rounding of means and deviations grows with the values: bounds give way by that much
    size = np.abs(vectors).max(axis=1, initial=0) + np.abs(ordered.points).max(initial=0) + 1.0
    slack = ROUNDING * size * size * ordered.n
    up = np.searchsorted(ordered.mean, mean)
    down = up - 1
    measured, open_rows = 0, np.arange(rows)
    while len(open_rows):
        above = np.where(up[open_rows] < k, ordered.mean[np.minimum(up[open_rows], k - 1)] - mean[open_rows], np.inf)
        below = np.where(down[open_rows] >= 0, mean[open_rows] - ordered.mean[np.maximum(down[open_rows], 0)], np.inf)
        upward = above <= below
        step = np.where(upward, above, below)
        # the nearer of both means is too far off: so is every mean farther out
        going = np.isfinite(step)
        going[going] = ordered.n * step[going] ** 2 - slack[open_rows[going]] <= best[open_rows[going]]
        open_rows, upward, step = open_rows[going], upward[going], step[going]
        at = np.where(upward, up[open_rows], down[open_rows])
        up[open_rows] += upward
        down[open_rows] -= ~upward
        bound = ordered.n * step**2 + (deviation[open_rows] - ordered.deviation[at]) ** 2 - slack[open_rows]
        near = bound <= best[open_rows]
        who, which = open_rows[near], at[near]
        apart = vectors[who] - ordered.points[which]
        distance = np.einsum("ij,ij->i", apart, apart)
        measured += len(who)
        number = ordered.number[which]
        better = (distance < best[who]) | ((distance == best[who]) & (number < winner[who]))
        best[who[better]], winner[who[better]] = distance[better], number[better]
    return winner, best, measured


def integer_vectors(table: DataFrame, vector_id: str, vector: str, options: Options) -> DataFrame:
    """(id, v) of the rows that take part; v holds floor(scale * x), x as double."""
    parts = F.col(f"`{vector}`").cast("array<double>")
    whole = (F.size(parts) == options.dimensions) & ~F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(parts, lambda x: F.floor(F.lit(float(options.scale)) * x))
    fits = ~F.exists(parts, lambda x: F.abs(x * float(options.scale)) >= float(LARGEST))
    checked = F.when(fits, scaled).otherwise(F.raise_error(F.lit(f"a component times {options.scale} passes {LARGEST}")).cast("array<bigint>"))
    return table.filter(parts.isNotNull() & whole).select(F.col(f"`{vector_id}`").alias("id"), checked.cast("array<int>").alias("v"))


def seeds(vectors: DataFrame, options: Options) -> np.ndarray:
    """The `k` vectors with the least hash of salt and id; equal hashes in the order of their components."""
    hashed = F.sha2(F.concat(F.lit(options.salt), F.col("id").cast("string")), 256)
    first = vectors.select(hashed.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(options.k).collect()
    return np.array([r.v for r in first], np.int64).reshape(len(first), options.dimensions)


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)


def summing(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's rows to one row for each centroid it met: count and component sums."""
    ordered = Ordered(centroids)
    k, dimensions = centroids.shape

    def run(batches):
        sums, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            vectors = matrix(batch.column("v"), dimensions)
            cluster, _, _ = nearest(vectors, ordered)
            order = np.argsort(cluster, kind="stable")
            starts = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            if len(starts):
                sums[cluster[order][starts]] += np.add.reduceat(vectors[order], starts, axis=0)
                counts += np.bincount(cluster, minlength=k)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met), pa.array(counts[met]), pa.array(list(sums[met]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"]
        )

    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: sums per task, summed over tasks by Spark; `k` rows reach the driver. Empty centroids stay."""
    partial = vectors.select("v").mapInArrow(summing(centroids), "cluster long, n long, sums array<long>")
    wide = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(centroids.shape[1])]
    out = centroids.copy()
    for row in partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*wide).alias("sums")).collect():
        out[row.cluster] = [int(s) // row.n for s in row.sums]
    return out


def assigning(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    ordered = Ordered(centroids)

    def run(batches):
        for batch in batches:
            cluster, distance, _ = nearest(matrix(batch.column("v"), centroids.shape[1]), ordered)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"]
            )

    return run


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    table: DataFrame, vector_id: str = "vec_id", vector: str = "embedding", options: Options = Options()
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) per vector, written once, and the final centroids."""
    spark: SparkSession = table.sparkSession
    vectors = settled(integer_vectors(table, vector_id, vector, options), "vectors")
    centroids = seeds(vectors, options)
    kind = vectors.schema["id"].dataType.simpleString()
    if not len(centroids):
        return spark.createDataFrame([], f"id {kind}, cluster int, distance long"), centroids
    for _ in range(options.rounds):
        centroids = moved(vectors, centroids)
    return settled(vectors.mapInArrow(assigning(centroids), f"id {kind}, cluster int, distance long"), "clusters"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the summed distances of the row's cluster and of all, and the digest of its centroid.

    The totals are one row per centroid; they and the digests are literals of the plan.
    """
    total = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    if any(x > np.iinfo(np.int64).max for x in (*total.values(), sum(total.values()))):
        raise OverflowError("summed distances pass a long")
    spark = assigned.sparkSession
    rows = [(i, total.get(i, 0), sum(total.values()), digest(c)) for i, c in enumerate(centroids)]
    of_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of_cluster), "cluster")  # a row per centroid, MOST_CENTROIDS at the most
