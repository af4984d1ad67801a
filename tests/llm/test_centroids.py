import math
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from marquee.llm.centroids import Walks, cluster


def slow(rows, k, rounds, dims):
    """The definition, a vector at a time."""
    points = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    points = [(i, v) for i, v in points if all(abs(x) <= 1 << 27 for x in v)]
    named = sorted((sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in points)
    centroids = [v for _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in points]
        for j in range(len(centroids)):
            mine = [v for (_, v), c in zip(points, of) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [nearest(v) for _, v in points]
    inertia = Counter()
    for d, j in last:
        inertia[j] += d
    names = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), names[j]) for (i, _), (d, j) in zip(points, last))


@pytest.mark.parametrize("k,dims,spread", [(16, 64, 1.0), (7, 5, 0.05), (40, 3, 2.0), (1, 2, 1.0)])
def test_walks_find_the_nearest(k, dims, spread):
    rng = np.random.default_rng(k)
    centroids = np.floor(64 * spread * rng.normal(size=(k, dims))).astype(np.int64)
    centroids[k // 2] = centroids[0]  # a tie wherever it is nearest
    x = np.floor(64 * spread * rng.normal(size=(3000, dims))).astype(np.int64)
    x[:k] = centroids
    number, distance = Walks(centroids).nearest(x)
    full = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_against_the_definition(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4) * rng.choice([0.02, 1])]) for i in range(300)]
    rows += rows[:20] + [(7, [0.5, 0.5, 0.5, 0.5]), (None, [1.0, 2.0, -3.0, 0.0]), (400, None), (401, [1.0]), (402, [1.0, None, 1.0, 1.0])]
    rows += [(403, [1.0, math.nan, 1.0, 1.0]), (404, [math.inf, 1.0, 1.0, 1.0]), (405, [-math.inf, 1.0, 1.0, 1.0]), (406, [1e30, 1.0, 1.0, 1.0]), (407, [])]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, at string").repartition(5)
    assert Counter(tuple(r) for r in cluster(docs, k=16, dims=4).collect()) == slow(rows, 16, 3, 4)
    assert Counter(tuple(r) for r in cluster(docs.limit(3), k=16, dims=4).collect()) == slow([tuple(r) for r in docs.limit(3).select("vec_id", "embedding").collect()], 16, 3, 4)


def test_one_vector_repeated(spark):
    docs = spark.createDataFrame([(1, [0.25] * 64)] * 50, "vec_id long, embedding array<float>")
    assert {tuple(r)[:5] for r in cluster(docs).collect()} == {(1, 0, 0, 0, 0)}


def test_empty(spark):
    out = cluster(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))
    assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
