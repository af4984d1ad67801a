"""ALS with factors in files against Spark's ALS, and its lists against all scores."""

import numpy as np
import pytest

from marquee.operators import als
from marquee.operators import models as M


def _ratings(spark):
    """Item 3 is hot; ids have gaps; a rating comes twice; some are 0 or below."""
    rng = np.random.default_rng(8)
    rows = [(int(u) * 7 + 2**40, int(i) * 3, float(r)) for u in range(60) for i, r in zip(rng.choice(40, 9, replace=False), rng.integers(-1, 11, 9) / 2)]
    rows += [(u * 7 + 2**40, 9, 4.0) for u in range(60)] + rows[:5]
    return spark.createDataFrame(rows, "userId long, movieId long, rating double")


@pytest.mark.parametrize("implicit", [False, True])
def test_factors_are_those_of_sparks_als(spark, monkeypatch, implicit):
    from pyspark.ml.recommendation import ALS

    monkeypatch.setattr(als, "TASK_ROWS", 50)  # several files a side
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # the hot item spans batches
    try:
        model = M.als_fit(_ratings(spark), 5, 0.1, 4, implicit, 0.5)
        assert len(model.item_factors.parts) > 1
        codes = [{r["id"]: r["code"] for r in t.collect()} for t in (model.users, model.items)]
        found = [{codes[k][r["id"]]: r["vec"] for r in M.factors(model, w).collect()} for k, w in enumerate(("user", "item"))]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    data = spark.createDataFrame([(codes[0][r.userId], codes[1][r.movieId], r.rating) for r in _ratings(spark).collect()], "u int, i int, r float")

    def fitted(n):
        spark_als = ALS(rank=5, regParam=0.1, maxIter=n, implicitPrefs=implicit, alpha=0.5, seed=42, userCol="u", itemCol="i", ratingCol="r")
        fit = spark_als.fit(data)
        return [{r["id"]: r["features"] for r in f.collect()} for f in (fit.userFactors, fit.itemFactors)]

    want, less = fitted(4), fitted(3)
    for k in (0, 1):
        assert found[k].keys() == want[k].keys()
        assert all(np.allclose(found[k][c], want[k][c], atol=1e-4) for c in want[k])
    assert not all(np.allclose(found[0][c], less[0][c], atol=1e-4) for c in less[0])


def test_a_half_iteration_shuffles_nothing(spark):
    items = M.als_fit(_ratings(spark), 3, 0.1, 1).item_factors
    dealt = M.cut_lineage(als._dealt(spark.createDataFrame([(0, 0, 1.0), (1, 0, 2.0)], "_u int, _i int, rating float"), "_u", ["_i", "rating"], 2))
    job = dealt.mapInArrow(lambda b: als._stored(als._solved(b, items, 0.1, None), "/nowhere", 3), als._PART)
    assert "Exchange" not in job._jdf.queryExecution().executedPlan().toString()


def test_lists_and_predictions_against_all_scores(spark, monkeypatch):
    monkeypatch.setattr(als, "TASK_ROWS", 100)
    monkeypatch.setattr(als, "SCORE_USERS", 7)
    monkeypatch.setattr(als, "SCORE_ITEMS", 6)
    model = M.als_fit(_ratings(spark), 4, 0.1, 2)
    u, i = ({r["id"]: np.array(r["vec"]) for r in M.factors(model, w).collect()} for w in ("user", "item"))
    for n in (3, 50):
        got = {}
        for r in model.recommend_all(n).collect():
            got.setdefault(r["userId"], []).append((r["rank"], r["movieId"], r["predicted_rating"]))
        assert got.keys() == u.keys()
        for x, found in got.items():
            found.sort()
            assert [f[0] for f in found] == list(range(1, min(n, len(i)) + 1)) and len({f[1] for f in found}) == len(found)
            assert np.allclose([f[2] for f in found], sorted((float(u[x] @ v) for v in i.values()), reverse=True)[:n], atol=1e-5)
            assert all(abs(float(u[x] @ i[f[1]]) - f[2]) < 1e-5 for f in found)
    one, other = next(iter(u)), next(iter(i))
    rows = spark.createDataFrame([(one, other), (one, -1), (-1, other)], "userId long, movieId long")
    p = {(r["userId"], r["movieId"]): r["prediction"] for r in model.predict(rows).collect()}
    assert abs(p[(one, other)] - float(u[one] @ i[other])) < 1e-5 and p[(one, -1)] is None and p[(-1, other)] is None


def test_the_start_takes_one_rating_of_a_user_and_files_hold_whole_codes(spark, monkeypatch):
    """Spark's ALS gets a row a user, not all ratings; a code's rows stay in one file and may span batches."""
    from pyspark.ml.recommendation import ALS

    started, plain = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, df, *a: started.append(df.groupBy("_u").count().collect()) or plain(self, df, *a))
    monkeypatch.setattr(als, "TASK_ROWS", 50)
    want = {r["id"]: r["vec"] for r in M.factors(M.als_fit(_ratings(spark), 4, 0.1, 2)).collect()}
    monkeypatch.setattr(als, "BATCH_ROWS", 7)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "5")
    try:
        coded = M.als_ratings(_ratings(spark))
        for folder, code in ((coded.dealt.by_item, "_i"), (coded.dealt.by_user, "_u")):
            of = spark.read.parquet(folder).selectExpr(code, "_metadata.file_name AS f").distinct()
            assert of.select("f").distinct().count() > 1 and of.groupBy(code).count().where("count > 1").isEmpty()
        found = {r["id"]: r["vec"] for r in M.factors(M.als_fit(coded, 4, 0.1, 2)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert [{r["count"] for r in rows} for rows in started] == [{1}, {1}] and len(started[0]) == 60
    assert found.keys() == want.keys() and all(np.allclose(found[i], want[i], atol=1e-5) for i in want)


def test_null_ratings_are_refused(spark):
    rows = spark.createDataFrame([(1, 1, 2.0), (1, 2, None)], "userId long, movieId long, rating double")
    with pytest.raises(Exception, match="null or NaN"):
        M.als_fit(rows, 2, 0.1, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_factors_are_neither_broadcast_nor_shuffled(spark):
    """Spark takes rows made by Python for a few bytes, so joins with factors, or lists, were broadcast whatever their size."""
    model = M.als_fit(_ratings(spark), 3, 0.1, 1)
    for which in ("user", "item"):
        assert "Join" not in _plan(M.factors(model, which))
    assert "MapInArrow" not in _plan(model.predict(_ratings(spark))) and "BroadcastExchange" not in _plan(model.recommend_all(5))
    few = spark.createDataFrame([(3.5, 1), (3.5, None), (7.0, 10**6)], "id double, code int")  # a dictionary's codes need not be in the fit
    assert [(r["id"], len(r["features"])) for r in model.user_factors.vectors(few).collect()] == [(3.5, 3)]


def test_fold_in_looks_factors_up(spark, monkeypatch):
    """No side is broadcast; only heavy users send sums; unknown items, nulls and repeated factors count as in a join."""
    from marquee.operators import relational

    monkeypatch.setattr(als, "BATCH_ROWS", 7)
    rng = np.random.default_rng(4)
    factors = [(i, rng.normal(size=3).tolist()) for i in range(20)]
    factors += [(5, [1.0, 2.0, 3.0]), (None, [9.0, 9.0, 9.0])]
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(6) for i in range(0, 20, 1 + u)] + [(0, 3, 2.0), (0, 99, 5.0), (8, 99, 5.0), (None, 1, 1.0), (1, None, 1.0)]
    f, r = spark.createDataFrame(factors, "id long, vec array<double>"), spark.createDataFrame(rows, "userId long, movieId long, rating double")
    for heavy in (100, 8):
        monkeypatch.setattr(relational, "HEAVY", heavy)
        out = M.fold_in_users(r, f, 0.1)
        assert heavy < 100 or "Join" not in _plan(out)
        found = {x["id"]: x["vec"] for x in out.collect()}
        assert found.keys() == set(range(6))
        for u, vec in found.items():
            mine = [(v, x) for w, i, x in rows if w == u and i is not None for k, v in factors if k == i]
            v, y = np.array([m[0] for m in mine]), np.array([m[1] for m in mine])
            assert np.allclose(vec, np.linalg.solve(v.T @ v + 0.1 * len(mine) * np.eye(3), v.T @ y))
