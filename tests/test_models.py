"""Rows-and-invariants checks for model queries (fits are not oracle-comparable)."""

import numpy as np
from pyspark.sql import functions as F

from marquee.operators import clustering as Cl
from tests.conftest import SF_CHECK, SF_SMALL


def q(entry, spark, name, sf=SF_SMALL):
    return entry.queries()[name](spark, sf)


def test_kmeans_assigns_each_id_once(spark, entry):
    rows = q(entry, spark, "kmeans_items").collect()
    ids = [r.id for r in rows]
    assert len(ids) == len(set(ids)) == 500
    assert all(0 <= r.cluster < 150 for r in rows)


def test_k_sweep_metrics(spark, entry):
    rows = sorted(q(entry, spark, "k_sweep").collect(), key=lambda r: r.k)
    assert [r.k for r in rows] == list(range(2, 21))
    assert all(-1 <= r.silhouette <= 1 and r.inertia > 0 and r.davies_bouldin > 0 for r in rows)


def test_quality_of_fits_is_that_of_each_labelling(spark):
    """Two passes over (id, vec, labels) give the measures of the long form, with a singleton and an unused label too."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=3)], [i % 2, 2 if i == 0 else i % 2, i % 3]) for i in range(40)]
    fits = spark.createDataFrame(rows, "id bigint, vec array<double>, labels array<int>").repartition(3)
    ks = [2, 3, 4]
    long = fits.select("id", "vec", F.posexplode("labels").alias("p", "cluster")).withColumn("k", F.col("p") + 2)
    names = ["k", "silhouette", "calinski_harabasz", "davies_bouldin", "inertia"]
    got, expect = ({r.k: r for r in x.select(names).collect()} for x in (Cl.quality_of_fits(fits, ks), Cl.quality_by_group(long, ["k"])))
    assert got.keys() == expect.keys() == set(ks)
    for k in ks:
        np.testing.assert_allclose(list(got[k]), list(expect[k]), atol=2e-6)


def test_segment_features_are_scaled_once(spark, entry):
    """The encodings are read from the written matrix; it is not grouped again for them."""
    plan = q(entry, spark, "encode_user_segments")._jdf.queryExecution().toString()
    assert "Scan" in plan and "Aggregate" not in plan


def test_rating_models_are_no_worse_than_the_mean(spark, entry):
    for name in ("rating_als", "rating_regressor"):
        r = q(entry, spark, name).first()
        assert 0 < r.rmse <= 1.01 * r.mean_rmse


def test_encodings_have_fixed_dims(spark, entry):
    assert {len(r.vec) for r in q(entry, spark, "encode_items").collect()} == {64}
    seg = q(entry, spark, "encode_user_segments")
    assert len({len(r.vec) for r in seg.collect()}) == 1


def test_bridge_and_weak_dims(spark, entry):
    s = q(entry, spark, "bridge_scores").collect()
    assert len(s) == 64 and all(r.r2 > -1e-6 for r in s)
    w = q(entry, spark, "weak_dims").first()
    assert set(w.weak_factors) <= {r.factor for r in s}


def test_predicted_topk_ranks(spark, entry):
    rows = q(entry, spark, "predicted_topk").collect()
    by_user = {}
    for r in rows:
        by_user.setdefault(r.userId, []).append(r)
    for rs in by_user.values():
        rs.sort(key=lambda r: r.rank)
        assert [r.rank for r in rs] == list(range(1, len(rs) + 1))
        assert all(a.predicted_rating >= b.predicted_rating for a, b in zip(rs, rs[1:]))


def test_fold_in_and_new_user_recs(spark, entry):
    f = q(entry, spark, "fold_in_users").collect()
    assert len(f) == 3 and all(len(r.vec) == 64 for r in f)
    recs = q(entry, spark, "new_user_recs")
    assert recs.columns == ["request_id", "movie_id", "title", "genres", "ensemble_score", "supported_by_users", "rank"]
    by = {}
    for r in recs.collect():
        by.setdefault(r.request_id, []).append(r["rank"])
        assert r.ensemble_score >= 1
    assert set(by) <= {r.id for r in f} and by and all(sorted(v) == list(range(1, 51)) for v in by.values())


def test_fold_in_solves_the_normal_equations(spark, monkeypatch):
    import numpy as np

    from marquee.operators import models as M

    rnd = np.random.default_rng(3)
    items = {i: rnd.normal(size=4) for i in range(30)}
    ratings = [(u, i, float(rnd.integers(1, 6))) for u in (1, 2, 3) for i in range(30) if (u + i) % 3 or u == 2]
    f = spark.createDataFrame([(i, v.tolist()) for i, v in items.items()], "id bigint, vec array<double>")
    r = spark.createDataFrame(ratings, "userId bigint, movieId bigint, rating double").repartition(5)
    for x in M.fold_in_users(r, f, 0.1).collect():
        mine = [(i, v) for u, i, v in ratings if u == x.id]
        V, y = np.array([items[i] for i, _ in mine]), np.array([v for _, v in mine])
        assert np.allclose(x.vec, np.linalg.solve(V.T @ V + 0.1 * len(mine) * np.eye(4), V.T @ y))


def test_pca_against_numpy(spark):
    import numpy as np

    from marquee.operators import models as M

    X = np.random.default_rng(6).normal(size=(80, 5)) * [5, 3, 1, 0.5, 0.1] + 7
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "id bigint, vec array<double>")
    C = X - X.mean(axis=0)
    _, _, vt = np.linalg.svd(C, full_matrices=False)
    want = ((C - C @ vt[:2].T @ vt[:2]) ** 2).mean()
    assert abs(M.pca_reconstruction_mse(M.pca_fit(df, 2), df).first()[0] - want) < 2e-6


def test_add_items_places_every_item_once(spark, entry):
    rows = q(entry, spark, "add_items", SF_CHECK).collect()
    ids = [r.id for r in rows]
    assert len(ids) == len(set(ids))
    new = [r for r in rows if r.donor_id is not None]
    assert len(new) == 1500 and all(r.cluster is not None for r in new)


def test_new_item_recs_exclude_seed(spark, entry):
    out = q(entry, spark, "new_item_recs", SF_CHECK)
    assert out.where(F.col("request_id") == F.col("movie_id")).count() == 0
    w = out.where(F.col("rank") == 1).select("weight").distinct().collect()
    assert [r.weight for r in w] == [20.0]


def test_knn_lsh_similarity_bounds(spark, entry):
    rows = q(entry, spark, "knn_lsh").collect()
    assert all(r.query_id != r.candidate_id for r in rows)
    assert all(0.3 - 1e-6 <= r.similarity <= 1 + 1e-6 for r in rows)


def test_recommendation_invariants(spark, entry):
    cb = q(entry, spark, "content_with_block")
    blocked = {r.movieId for r in entry.queries()["importance_last"](spark, SF_SMALL).collect() if r.importance_score == -1}
    rows = cb.collect()
    assert not ({r.movie_id for r in rows} & blocked)
    hy = q(entry, spark, "hybrid_neighbours").collect()
    assert not ({r.movie_id for r in hy} & {1, 10, 100})
    ws = sorted(hy, key=lambda r: r.rank)
    assert all(a.weight >= b.weight for a, b in zip(ws, ws[1:]))


def test_knn_lsh_recall(spark, entry):
    """At the registered parameters, of all pairs of different items with a cosine of 0.3 or more."""
    from marquee.plans.model_queries import _items

    rows = _items(spark, SF_CHECK).select("id", "vec").collect()
    ids, vec = np.array([r["id"] for r in rows]), np.array([r["vec"] for r in rows], float)
    vec /= np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-300)
    near = vec @ vec.T >= 0.3 + 1e-6
    np.fill_diagonal(near, False)
    exact = {(ids[i], ids[j]) for i, j in zip(*np.nonzero(near))}
    found = {(r["query_id"], r["candidate_id"]) for r in entry.queries()["knn_lsh"](spark, SF_CHECK).select("query_id", "candidate_id").collect()}
    recall = len(exact & found) / len(exact)
    print(f"knn_lsh: {len(exact & found)} of {len(exact)} pairs, recall {recall:.4f}")
    assert recall >= 0.9


def test_fewer_item_blocks_give_the_same_als_model(spark, monkeypatch):
    """The random start depends on the blocks of users alone, so a model of fewer item blocks is that of Spark's ten."""
    from marquee.operators import models as M

    rng = np.random.default_rng(5)
    rows = [(int(u), int(i), float(r)) for u in range(40) for i, r in zip(rng.choice(30, 12, replace=False), rng.integers(1, 11, 12) / 2)]
    ratings = spark.createDataFrame(rows, "userId long, movieId long, rating double")
    assert M.USER_BLOCKS == 10 and M.ITEM_BLOCKS < 10
    for implicit in (False, True):
        found = []
        for blocks in (M.ITEM_BLOCKS, 10):
            monkeypatch.setattr(M, "ITEM_BLOCKS", blocks)
            model = M.als_fit(ratings, 4, 0.1, 5, implicit)
            monkeypatch.undo()
            found.append({(w, r["id"]): r["vec"] for w in ("user", "item") for r in M.factors(model, w).collect()})
        assert found[0].keys() == found[1].keys()
        assert all(np.allclose(found[0][x], found[1][x], atol=1e-3) for x in found[0])


def test_ratings_are_derived_once_for_all_fits_of_a_report(spark):
    """What the fits and scores of the validation read is written: no scan of the tables, no join."""
    from marquee.plans import model_queries as Q

    seen = []

    def fit(df, reg):
        seen.append(df)
        return lambda x: seen.append(x) or x.withColumn("prediction", F.lit(reg))

    train, test = Q._split_ratings(spark, SF_SMALL)
    Q._validated(train.join(test.select("userId").distinct(), "userId", "left_semi"), fit, (0.0, 1.0))
    assert len(seen) == 5
    for df in [train, test, *seen]:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "Join" not in plan


def test_fits_on_the_same_rows_share_them_coded(spark, monkeypatch):
    from marquee.operators import models as M
    from marquee.plans import model_queries as Q

    coded, plain = [], M.als_ratings
    monkeypatch.setattr(M, "als_ratings", lambda df, *a: coded.append(df) or plain(df, *a))
    monkeypatch.setattr(Q, "FACTORS", 3)
    monkeypatch.setattr(Q, "ITERATIONS", 1)
    rows = spark.createDataFrame([(u, i, float((u * i) % 5)) for u in range(30) for i in range(10)], "userId long, movieId long, rating double")
    predict = Q._validated(rows, Q._als_predictor(), (0.5, 1.0))
    assert len(coded) == 2 and predict(rows).where("prediction IS NULL").isEmpty()
