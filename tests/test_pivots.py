"""Pivot partitions against the grid: equal rows, and fewer pairs where vectors lie in clusters."""

import numpy as np
import pytest

from marquee.operators import neighbours
from marquee.operators.neighbours import knn_lsh, knn_scan
from marquee.operators import pivots
from marquee.operators.pivots import PivotSearch, knn_pivots


def _vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in rows], "id long, vec array<double>, cluster int").repartition(4).cache()


def _rows(df):
    return sorted((r["request_id"], r["rank"], r["candidate_id"], r["similarity"]) for r in df.collect())


def _clustered(seed, n, dims=8, groups=12, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    return [(i, centres[i % groups] + spread * rng.normal(size=dims)) for i in range(n)]


@pytest.mark.parametrize("exclude_self", [True, False])
def test_equal_to_the_grid_with_zeros_ties_and_copies(spark, exclude_self):
    rows = _clustered(1, 260)
    rows += [(1000 + i, v) for i, v in rows[:15]]  # copies: ties at 1
    rows += [(2000 + i, [0.0] * 8) for i in range(14)]  # zero vectors
    rows += [(3000 + i, 2.5 * np.array(rows[0][1])) for i in range(12)]  # equal directions
    vectors = _vectors(spark, rows)
    requests = vectors.selectExpr("id", "id + 7 AS request_id")
    for k in (1, 10):
        assert _rows(knn_pivots(requests, vectors, vectors, k, exclude_self)) == _rows(knn_scan(requests, vectors, vectors, k, exclude_self))


def test_few_candidates_and_none(spark):
    vectors = _vectors(spark, [(1, [1, 0]), (2, [0, 1]), (3, [0, 0])])
    requests = vectors.selectExpr("id", "id AS request_id")
    assert _rows(knn_pivots(requests, vectors, vectors, 5)) == _rows(knn_scan(requests, vectors, vectors, 5))
    for some in (vectors.where("id = 3"), vectors.limit(0)):
        assert _rows(knn_pivots(requests, vectors, some, 2, False)) == _rows(knn_scan(requests, vectors, some, 2, False))


def test_pairs_scored_are_sub_quadratic_on_clusters(spark):
    shares = []
    for n in (300, 1200):
        vectors = _vectors(spark, _clustered(2, n, groups=n // 30))
        search = PivotSearch(vectors.selectExpr("id", "id AS request_id"), vectors, vectors, 3)
        row = search.pairs().first()
        assert row["requests"] == row["candidates"] == n
        shares.append(row["pairs_scored"] / n**2)
    assert shares[0] < 0.5 and shares[1] < shares[0] / 1.5, shares


@pytest.mark.parametrize("wide", [50, 100_000])
def test_requests_are_copied_once_a_block(spark, wide, monkeypatch):
    """Vectors in no clusters: no cell can be ruled out, yet a request goes once to each block, whole or cut."""
    monkeypatch.setattr(pivots, "WIDE", wide)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=32)) for i in range(200)] + [(200 + i, np.eye(32)[0] + 1e-3 * rng.normal(size=32)) for i in range(150)]
    vectors = _vectors(spark, rows)
    requests = vectors.selectExpr("id", "id AS request_id")
    search = PivotSearch(requests, vectors, vectors, 5)
    assert _rows(search.result) == _rows(knn_scan(requests, vectors, vectors, 5))
    sent, cells = search._away(False).selectExpr("count(*)", "sum(size(cells))").first()
    blocks = len(np.unique(search.cells.block))
    assert sent <= 350 * blocks and cells > 3 * 350
    if wide == 50:
        assert search.cells.parts.max() > 1 and blocks > 1
    else:
        assert blocks == 1 and sent <= 350


def test_lsh_pairs_are_those_of_the_similarity_join(spark, monkeypatch):
    """Equal to approxSimilarityJoin, without its join of vectors by bucket: zero vectors, copies and repeated rows too."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    monkeypatch.setattr(neighbours, "LSH_ROWS", 40)
    rows = _clustered(4, 150, groups=20, spread=0.3)
    rows += [(500 + i, rows[i][1]) for i in range(10)] + rows[:5] + [(700, [0.0] * 8), (701, [0.0] * 8), (3, rows[9][1])]
    vectors = _vectors(spark, rows).select("id", "vec")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    unit = vectors.select("id", array_to_vector(F.when(norm == 0, F.col("vec")).otherwise(F.transform("vec", lambda x: x / norm))).alias("f"))
    model = BucketedRandomProjectionLSH(inputCol="f", outputCol="hashes", bucketLength=0.5, numHashTables=4, seed=42).fit(unit)
    joined = model.approxSimilarityJoin(unit, unit, 1.4**0.5, "d").where("datasetA.id <> datasetB.id")
    expected = sorted((r[0], r[1], r[2]) for r in joined.selectExpr("datasetA.id", "datasetB.id", "round(1 - d * d / 2, 6)").collect())
    found = knn_lsh(vectors, vectors, 0.3)
    assert sorted(tuple(r) for r in found.collect()) == expected and len(expected) > 500
    assert "datasetA" not in found._jdf.queryExecution().executedPlan().toString()  # no rows with both vectors
