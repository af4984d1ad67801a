"""Clustering of vectors around centroids, assigned by the threshold algorithm (operator 12).

Vectors are turned into integers, so distances and sums are exact and agree on any partitioning. A
vector's nearest centroid comes from one sorted list of the centroids a dimension. In all lists a
walk goes outward from the vector's own value, a step at a time to the nearer side. Each centroid that
is met for the first time is compared in full. No centroid that has not been met can be nearer than
the sum of the last steps' squared distances, so a walk ends when this sum strictly exceeds the
best full distance: then ties are found too, and go to the smaller number.

Tasks walk blocks of ``BLOCK`` vectors at once. In a round each task adds up its vectors by cluster, so
k rows a task are shuffled; the driver gets k x dims sums, bounded by the parameters, and sends the
k centroids to the next round's tasks. The integers are written once and read by every round.

Defined cases: a vector that is null, has not ``dims`` components, or has a null or non-finite one is
left out, and so is one with an integer beyond +-2**27, where a distance or sum could leave 64 bits.
Fewer vectors than k give fewer centroids. Rows with equal ids are rows of their own; equal hashes are
ordered by the vectors. A null id is hashed as an empty one. A sum beyond 64 bits is null. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written

#: Vectors of a block of walks, and the largest integer of a component.
BLOCK, LARGEST = 1024, 1 << 27
_FAR = np.int64(1) << 30  # beyond any difference of two components


class Walks:
    """The sorted lists of ``centroids`` (k x dims integers)."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.lists = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row of ``x``."""
        k, dims = self.lists.shape
        rows, every = len(x), np.arange(dims)
        high = np.stack([np.searchsorted(self.lists[:, j], x[:, j]) for j in range(dims)], axis=1)
        low = high - 1
        best = np.full(rows, np.iinfo(np.int64).max)
        number = np.zeros(rows, np.int64)
        met = np.zeros((rows, k), bool)
        at = np.arange(rows)  # the walks that go on
        for _ in range(k):
            below = np.where(low >= 0, x - self.lists[np.maximum(low, 0), every], _FAR)
            above = np.where(high < k, self.lists[np.minimum(high, k - 1), every] - x, _FAR)
            down = below <= above
            step = np.where(down, low, high)
            frontier = (np.minimum(below, above) ** 2).sum(axis=1)
            before = met.copy()
            met[np.arange(len(x))[:, None], self.order[step, every]] = True
            r, c = np.nonzero(met & ~before)
            full = np.full(met.shape, np.iinfo(np.int64).max)
            full[r, c] = ((x[r] - self.centroids[c]) ** 2).sum(axis=1)
            c = full.argmin(axis=1)  # the first of equals
            d = full[np.arange(len(x)), c]
            better = (d < best[at]) | ((d == best[at]) & (c < number[at]))
            best[at[better]], number[at[better]] = d[better], c[better]
            on = frontier <= best[at]
            if not on.any():
                break
            at, x, met = at[on], x[on], met[on]
            low, high = (low - down)[on], (high + ~down)[on]
        return number, best


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            yield part, part["at"].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def integers(vectors: DataFrame, vector: str = "embedding", dims: int = 64, scale: int = 64) -> DataFrame:
    """vec_id and ``at``, the integers of each vector that is kept; written."""

    def wide(x: Column) -> Column:
        return x.cast("double") * scale

    good = (F.size(vector) == dims) & F.forall(vector, lambda x: x.isNotNull() & (wide(x) >= -LARGEST) & (wide(x) < LARGEST + 1))  # a NaN is above all
    return written(vectors.where(F.coalesce(good, F.lit(False))).select("vec_id", F.transform(vector, lambda x: F.floor(wide(x)).cast("int")).alias("at")), "integers")


def first_centroids(points: DataFrame, k: int, seed: str = "1") -> np.ndarray:
    """The k vectors with the smallest hashes of their ids, in that order."""
    name = F.sha2(F.concat_ws("", F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = points.select(name.alias("name"), "at").orderBy("name", "at").limit(k).collect()  # k vectors
    return np.array([r["at"] for r in rows], np.int64)


def next_centroids(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The rounded-down means of the vectors nearest to each centroid; empty ones stay."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks, sums, counts = Walks(centroids), np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, x in _blocks(batches, dims):
            number, _ = walks.nearest(x)
            order = np.argsort(number, kind="stable")
            found, first = np.unique(number[order], return_index=True)
            sums[found] += np.add.reduceat(x[order], first, axis=0)
            counts += np.bincount(number, minlength=k)
        some = np.flatnonzero(counts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * dims, pa.int32()), pa.array(sums[some].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some]), lists], names=["cluster", "n", "sums"])

    parts = points.select("at").mapInArrow(run, "cluster long, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("j", "x")).groupBy("cluster", "j").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    new = centroids.copy()
    for r in each.collect():  # k x dims sums
        new[r["cluster"], r["j"]] = r["x"] // r["n"]
    return new


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, vector: str = "embedding", dims: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that is kept."""
    points = integers(vectors, vector, dims, scale)
    spark = points.sparkSession
    centroids = first_centroids(points, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(points, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = Walks(centroids)
        for part, x in _blocks(batches, dims):
            number, distance = walks.nearest(x)
            yield pa.RecordBatch.from_arrays([part["vec_id"], pa.array(number.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    schema = points.select("vec_id").schema.add("cluster", "integer").add("distance", "long")
    placed = written(points.mapInArrow(run, schema), "placed")
    names = spark.createDataFrame([(i, sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))  # k rows
    whole = sums.agg(F.sum("sum").alias("all"))
    long = [F.expr(f"try_cast({c} AS long)").alias(a) for c, a in (("sum", "cluster_inertia"), ("all", "inertia"))]
    sums = written(sums.join(F.broadcast(whole)).select("cluster", *long).join(F.broadcast(names), "cluster"), "inertia")
    return placed.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
