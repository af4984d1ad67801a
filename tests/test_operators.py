"""Operator edge cases on tiny in-memory inputs, checked against brute-force Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.functions import columns as C
from marquee.operators import clustering as Cl
from marquee.operators import evaluation as E
from marquee.operators import models as M
from marquee.operators import neighbours as N
from marquee.operators import recommend as R
from marquee.operators import relational as Rel
from marquee.operators import users as U
from marquee.operators import vectors as Vec


def test_rank_weights_match_linspace(spark):
    rows = [(n, rn) for n in range(1, 61) for rn in range(1, n + 1)]
    df = spark.createDataFrame(rows, "n int, rn int").select("n", "rn", C.rank_weight("rn", "n").alias("w"))
    got = {(r.n, r.rn): r.w for r in df.collect()}
    for n in range(1, 61):
        expect = np.linspace(20, 1, n).round()
        for rn in range(1, n + 1):
            assert got[(n, rn)] == expect[rn - 1], (n, rn)


def test_cosine_zero_vector_is_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), ([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0])],
                               "a array<double>, b array<double>")
    got = [r.c for r in df.select(C.cosine("a", "b").alias("c")).collect()]
    assert got == [0.0, 1.0, 0.0]


def test_minmax_constant_dimension_maps_to_zero(spark):
    df = spark.createDataFrame([(1, [5.0, 1.0]), (2, [5.0, 3.0])], "id bigint, vec array<double>")
    got = {r.id: r.scaled for r in Vec.minmax_scale(df).collect()}
    assert got == {1: [0.0, 0.0], 2: [0.0, 1.0]}


def test_standard_scale_population_std(spark):
    df = spark.createDataFrame([(1, [1.0, 7.0]), (2, [3.0, 7.0])], "id bigint, vec array<double>")
    got = {r.id: r.scaled for r in Vec.standard_scale(df).collect()}
    assert got == {1: [-1.0, 0.0], 2: [1.0, 0.0]}


def test_interaction_matrix_sums_duplicates(spark):
    r = spark.createDataFrame([(1, 10, 2.0), (1, 10, 3.5), (2, 10, 1.0)], "userId bigint, movieId bigint, rating double")
    got = {(x.userId, x.movieId): x.rating for x in Rel.interaction_matrix(r).collect()}
    assert got == {(1, 10): 5.5, (2, 10): 1.0}


def test_keep_last_importance(spark):
    imp = spark.createDataFrame([(1, 1, 1), (1, -1, 2), (2, 1, 1)], "movieId bigint, importance_score int, seq int")
    got = {r.movieId: r.importance_score for r in Rel.keep_last(imp, "movieId", "seq").collect()}
    assert got == {1: -1, 2: 1}


def test_dense_index_is_numeric_order(spark):
    df = spark.createDataFrame([(x,) for x in [10, 2, 1, 11, 2]], "movieId bigint")
    got = {r.movieId: r.idx for r in Rel.dense_index(df, "movieId").collect()}
    assert got == {1: 0, 2: 1, 10: 2, 11: 3}


def test_parse_id_list(spark):
    df = spark.createDataFrame([("1, 23, x, 45 ,  ,7a",)], "t string")
    assert df.select(C.parse_id_list("t").alias("ids")).first().ids == [1, 23, 45]


def test_ratings_map_length_mismatch_raises(spark):
    df = spark.createDataFrame([([1, 2], [4.0])], "i array<bigint>, r array<double>")
    with pytest.raises(Exception):
        df.select(C.ratings_map("i", "r")).collect()


def _movies(spark, rows):
    return spark.createDataFrame(rows, "movieId bigint, title string, genres string")


def test_cold_start_fallback_and_empty_genres(spark):
    mv = _movies(spark, [(1, "a", "x|y"), (2, "b", "y|z"), (3, "c", None)])
    r = spark.createDataFrame([(1, 1, 4.0), (1, 2, 2.0), (2, 3, 5.0)], "userId bigint, movieId bigint, rating double")
    out = R.cold_start_by_genres(mv, r, ["q"], top_n=2, min_votes=1).collect()
    assert [x.movieId for x in out] == [1, 2]  # fallback: first n by id, then weighted rating
    with pytest.raises(ValueError):
        R.cold_start_by_genres(mv, r, [], top_n=2)


def _brute_neighbours(seeds, vecs, genres, clusters, gate, exclude_seeds, top_n):
    scores = {}
    for s in seeds:
        if s not in vecs:
            continue
        for c, v in vecs.items():
            if c == s or clusters[c] != clusters[s]:
                continue
            a, b = np.array(vecs[s]), np.array(v)
            na, nb = np.linalg.norm(a), np.linalg.norm(b)
            sim = 0.0 if na == 0 or nb == 0 else float(a @ b / (na * nb))
            if gate and not set(genres[s].split("|")) & set(genres[c].split("|")):
                sim = 0.0
            scores[c] = scores.get(c, 0.0) + sim
    if exclude_seeds:
        scores = {k: v for k, v in scores.items() if k not in seeds}
    ranked = sorted(scores.items(), key=lambda kv: (-round(kv[1], 6), kv[0]))[:top_n]
    w = np.linspace(20, 1, len(ranked)).round()
    return [(k, round(v, 6), float(w[i])) for i, (k, v) in enumerate(ranked)]


@pytest.mark.parametrize("gate,exclude", [(True, False), (False, True)])
@pytest.mark.parametrize("block", [2, 1024])
def test_content_neighbours_brute_force(spark, gate, exclude, block, monkeypatch):
    rnd = random.Random(7)
    ids = list(range(30))
    vecs = {i: [rnd.uniform(-1, 1) for _ in range(4)] for i in ids}
    vecs[5] = [0.0, 0.0, 0.0, 0.0]
    tokens = ["a", "b", "c", "d", "e"]
    genres = {i: "|".join(rnd.sample(tokens, 2)) for i in ids}
    clusters = {i: i % 3 for i in ids}
    seeds = [0, 3, 5, 7, 99]
    vdf = spark.createDataFrame([(i, vecs[i], clusters[i]) for i in ids], "id bigint, vec array<double>, cluster int")
    mdf = _movies(spark, [(i, f"t{i}", genres[i]) for i in ids])
    req = spark.createDataFrame([(1, s) for s in seeds], "request_id bigint, movieId bigint")
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    s, _ = N.cells(N.seed_rows(req, vdf, mdf), N.cluster_candidates(vdf, mdf), "movie_id")
    assert s._df.select("c_block").distinct().count() == (5 if block == 2 else 1)  # 10 candidates a cluster
    got = N.content_neighbours(req, vdf, mdf, top_n=10, gate=gate, exclude_seeds=exclude).orderBy("rank").collect()
    expect = _brute_neighbours(seeds, vecs, genres, clusters, gate, exclude, 10)
    assert [(r.movie_id, r.similarity_score, r.weight) for r in got] == expect


def test_sums_of_a_cell_are_per_request(monkeypatch):
    """A seed with NaN spoils its own request only, and a request with more seeds than a chunk is added up whole."""
    import pandas as pd

    monkeypatch.setattr(N, "_SUM_CHUNK", 3)
    rng = np.random.default_rng(3)
    c = rng.normal(size=(12, 4))
    who = np.array([7, 9, 7, 7, 5, 7, 7, 8, 7])
    seeds = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8])
    s = c[seeds].copy()
    s[7] = np.nan
    cp = pd.DataFrame({"movie_id": np.arange(12), "c_vec": list(c), "c_nrm": np.linalg.norm(c, axis=1), "c_tokens": [["a"]] * 12})
    sp = pd.DataFrame({"request_id": who, "seed_id": seeds, "s_vec": list(s), "s_nrm": np.linalg.norm(s, axis=1), "s_tokens": [["a"]] * 9})
    got = N._sum_kernel(True, False, 12)(None, sp, cp)
    unit = c / np.linalg.norm(c, axis=1)[:, None]
    for request in (5, 7, 9):
        own = seeds[who == request]
        expect = {m: sum(unit[x] @ unit[m] for x in own if x != m) for m in range(12) if list(own) != [m]}
        found = got[got.request_id == request].set_index("movie_id").sim_sum.to_dict()
        assert found.keys() == expect.keys()
        assert all(abs(found[m] - expect[m]) < 1e-9 for m in expect)


def test_content_neighbours_empty_request_keeps_schema(spark):
    vdf = spark.createDataFrame([(1, [1.0], 0)], "id bigint, vec array<double>, cluster int")
    mdf = _movies(spark, [(1, "t", "a")])
    req = spark.createDataFrame([], "request_id bigint, movieId bigint")
    out = N.content_neighbours(req, vdf, mdf)
    assert out.count() == 0
    assert out.columns == ["request_id", "movie_id", "title", "genres", "similarity_score", "weight", "rank"]


def test_similarity_bands_match_reference_windows(spark):
    sims = [0.0, 0.01, 0.0100001, 0.06, 0.11, 0.16000000000000003, 0.5, 0.99, 1.0, 1.06, -0.3]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sims)], "i int, similarity double")
    got = sorted((r.i, r.band) for r in U.similarity_bands(df).collect())
    expect = sorted((i, w) for i, s in enumerate(sims) for w, lo in enumerate(np.arange(0.01, 0.99, 0.05))
                    if lo < s <= lo + 0.1)
    assert got == expect


def test_co_rating_scores_brute_force_with_zero_fill(spark):
    rows = [(1, 1, 4.0), (1, 2, 3.0), (2, 2, 5.0), (2, 3, 1.0), (3, 9, 2.0), (1, 1, 1.0), (4, 7, 3.0)]
    r = spark.createDataFrame(rows, "userId bigint, movieId bigint, rating double")
    peers = spark.createDataFrame([(1,)], "peer_id bigint")
    got = [(x.movieId, x.score) for x in U.co_rating_scores(peers, r, top_n=4).orderBy("item_rank").collect()]
    m = {}
    for u, i, v in rows:
        m[(u, i)] = m.get((u, i), 0.0) + v
    users = sorted({u for u, _ in m})
    items = sorted({i for _, i in m})
    R_ = np.array([[m.get((u, i), 0.0) for i in items] for u in users])
    d = R_ @ R_[users.index(1)]
    score = d @ R_
    cand = [(items[j], float(score[j])) for j in range(len(items)) if R_[users.index(1), j] == 0]
    expect = sorted(cand, key=lambda t: (-t[1], t[0]))[:4]
    assert got == expect


def _rbo(l1, l2, p=0.9):
    """From the definition: an id counts from the depth at which both lists hold it."""
    depth = min(len(l1), len(l2))
    place = {m: i for i, m in enumerate(l2, 1)}
    joined = np.bincount([max(i, place[m]) for i, m in enumerate(l1, 1) if m in place], minlength=max(len(l1), len(l2)) + 1)
    agreement = np.cumsum(joined)[1 : depth + 1] / np.arange(1, depth + 1)
    return (1 - p) * float(agreement @ p ** np.arange(depth))


def test_list_measures_brute_force(spark):
    rnd = random.Random(3)
    lists = {}
    for req in range(20):
        pool = list(range(15))
        la = rnd.sample(pool, rnd.randint(1, 10))
        lb = rnd.sample(pool, rnd.randint(1, 10))
        lists[req] = (la, lb)
    a = spark.createDataFrame([(q, i + 1, m) for q, (la, _) in lists.items() for i, m in enumerate(la)],
                              "request_id bigint, rank int, movie_id bigint")
    b = spark.createDataFrame([(q, i + 1, m) for q, (_, lb) in lists.items() for i, m in enumerate(lb)],
                              "request_id bigint, rank int, movie_id bigint")
    rbo = {r.request_id: r.rbo for r in E.rbo(a, b).collect()}
    jac = {r.request_id: r.jaccard for r in E.jaccard(a, b).collect()}
    prec = {r.request_id: r.precision_at_k for r in E.precision_at_k(a, b, 5).collect()}
    pm = {r.request_id: r.position_match for r in E.position_match(a, b).collect()}
    curve = {(r.request_id, r.depth): r.overlap for r in E.overlap_curve(a, b, 10).collect()}
    for q, (la, lb) in lists.items():
        assert math.isclose(rbo[q], _rbo(la, lb), abs_tol=1e-12)
        assert jac[q] == len(set(la) & set(lb)) / len(set(la) | set(lb))
        assert prec[q] == len(set(la[:5]) & set(lb[:5])) / 5
        assert math.isclose(pm[q], sum(0.9 ** i for i in range(min(len(la), len(lb))) if la[i] == lb[i]), abs_tol=1e-12)
        for dpt in range(1, 11):
            assert curve[(q, dpt)] == len(set(la[:dpt]) & set(lb[:dpt]))


def test_closest_by_genres_brute_force(spark):
    rnd = random.Random(11)
    tokens = list("abcdefgh")
    movies = [(i, f"t{i}", "|".join(rnd.sample(tokens, rnd.randint(1, 7)))) for i in range(40)]
    mdf = _movies(spark, movies)
    with_vec = spark.createDataFrame([(i, [1.0], 0) for i in range(0, 40, 2)], "id bigint, vec array<double>, cluster int")
    reqs = [(100 + k, rnd.sample(tokens, rnd.randint(1, 5))) for k in range(15)] + [(200, []), (201, ["zz"])]
    rdf = spark.createDataFrame(reqs, "request_id bigint, genres array<string>")
    got = {r.request_id: (r.donor_id, r.overlap) for r in M.closest_by_genres(rdf, mdf, with_vec).collect()}
    for q, g in reqs:
        best = None
        for i, _, gen in movies:
            if i % 2:
                continue
            ov = len(set(g) & set(gen.split("|")))
            if ov and (best is None or (-ov, i) < (-best[1], best[0])):
                best = (i, ov)
        assert got[q] == (best or (None, 0))


def test_cluster_quality_matches_numpy(spark):
    rnd = np.random.default_rng(5)
    X = rnd.normal(size=(40, 3))
    lab = np.arange(40) % 4
    df = spark.createDataFrame([(i, X[i].tolist(), int(lab[i])) for i in range(40)],
                               "id bigint, vec array<double>, cluster int")
    cents = np.array([X[lab == k].mean(axis=0) for k in range(4)])
    inertia = sum(((X[i] - cents[lab[i]]) ** 2).sum() for i in range(40))
    assert math.isclose(Cl.inertia(df).first().inertia, round(inertia, 6), abs_tol=2e-6)
    s = np.array([np.linalg.norm(X[lab == k] - cents[k], axis=1).mean() for k in range(4)])
    db = np.mean([max((s[i] + s[j]) / np.linalg.norm(cents[i] - cents[j]) for j in range(4) if j != i) for i in range(4)])
    assert math.isclose(Cl.davies_bouldin(df).first().davies_bouldin, db, abs_tol=2e-6)
    g = X.mean(axis=0)
    B = sum((lab == k).sum() * ((cents[k] - g) ** 2).sum() for k in range(4))
    ch = (B / 3) / (inertia / 36)
    assert math.isclose(Cl.calinski_harabasz(df).first().calinski_harabasz, ch, rel_tol=1e-6)
    D2 = ((X[:, None] - X[None]) ** 2).sum(axis=2)
    own = [D2[i, [j for j in range(40) if lab[j] == lab[i] and j != i]].mean() for i in range(40)]
    oth = [min(D2[i, lab == k].mean() for k in range(4) if k != lab[i]) for i in range(40)]
    sq = np.mean([(b - a) / max(a, b) for a, b in zip(own, oth)])
    assert math.isclose(Cl.silhouette(df).first().silhouette, sq, abs_tol=2e-6)
    # exact silhouette over all 40 points (sample larger than the data)
    D = np.linalg.norm(X[:, None] - X[None], axis=2)
    sil = []
    for i in range(40):
        same = [j for j in range(40) if lab[j] == lab[i] and j != i]
        a = D[i, same].mean()
        b = min(D[i, lab == k].mean() for k in range(4) if k != lab[i])
        sil.append((b - a) / max(a, b))
    assert math.isclose(Cl.silhouette_sample(df, 100).first().silhouette, np.mean(sil), abs_tol=2e-6)


def test_watched_segments_list_is_whole_where_catalogue_rows_repeat(spark):
    """Each row of a watched movie that stands twice in the catalogue is passed over, and the list still has k entries."""
    req = spark.createDataFrame([(1, 1)], "request_id bigint, movieId bigint")
    mv = spark.createDataFrame([(i, f"t{i}", "a") for i in range(1, 7) for _ in range(2)], "movieId bigint, title string, genres string")
    ic = spark.createDataFrame([(i, 0) for i in range(1, 7) for _ in range(2)], "movieId bigint, cluster int")
    r = spark.createDataFrame([(u, i, 6.0 - i) for i in range(1, 7) for u in range(5)], "userId bigint, movieId bigint, rating double")
    out = sorted(U.watched_segments(req, ic, mv, r, top_k=6).collect(), key=lambda x: x["rank"])
    assert [x.movieId for x in out] == [2, 2, 2, 2, 3, 3]
    assert [x.title for x in out] == ["t2"] * 4 + ["t3"] * 2


def test_watched_segments_excludes_watched_and_ranks(spark):
    mv = _movies(spark, [(i, f"t{i}", "a") for i in range(1, 9)])
    ic = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "movieId bigint, cluster int")
    r = spark.createDataFrame([(u, i, float((i * u) % 5 + 1)) for u in range(1, 6) for i in range(1, 8)],
                              "userId bigint, movieId bigint, rating double")
    req = spark.createDataFrame([(1, 2), (1, 4)], "request_id bigint, movieId bigint")
    out = U.watched_segments(req, ic, mv, r, top_k=10).collect()
    ids = [x.movieId for x in sorted(out, key=lambda x: x.rank)]
    assert 2 not in ids and 4 not in ids and 8 not in ids  # watched / unrated excluded
    assert set(ids) == {6}


def test_ratings_map_repeated_id_keeps_last(spark):
    df = spark.createDataFrame([([1, 2, 1], [4.0, 3.0, 5.0])], "i array<bigint>, r array<double>")
    assert df.select(C.ratings_map("i", "r").alias("m")).first().m == {1: 5.0, 2: 3.0}


def test_assign_new_ids_continue_after_max(spark):
    existing = spark.createDataFrame([(1,), (5,)], "movieId bigint")
    new = spark.createDataFrame([("b",), ("a",), ("c",)], "title string")
    got = {r.title: r.movieId for r in Rel.assign_new_ids(new, existing, "movieId", "title").collect()}
    assert got == {"a": 6, "b": 7, "c": 8}


def test_many_genres_have_a_donor(spark):
    genres = [f"g{i}" for i in range(40)]
    mdf = _movies(spark, [(1, "a", "|".join(genres)), (2, "b", "|".join(genres[:32])), (3, "c", "g0")])
    vec = spark.createDataFrame([(1, [1.0], 0), (3, [1.0], 0)], "id bigint, vec array<double>, cluster int")
    req = spark.createDataFrame([(2, genres[:32])], "request_id bigint, genres array<string>")
    assert [tuple(r) for r in M.closest_by_genres(req, mdf, vec).collect()] == [(2, 1, 32)]


def test_assign_centroid_keeps_equal_ids(spark):
    cents = spark.createDataFrame([(0, [0.0]), (1, [10.0]), (2, [10.0])], "cluster int, centroid array<double>")
    df = spark.createDataFrame([(1, [1.0]), (1, [9.0])], "id bigint, vec array<double>")
    assert sorted(tuple(r) for r in Cl.assign_centroid(df, cents).collect()) == [(1, 0, 1.0), (1, 1, 1.0)]


def test_long_to_dense_fills_and_refuses(spark):
    from marquee.sources.io import long_to_dense

    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, 2.0), (1, 2, 3.0), (2, 0, 4.0), (2, 2, 5.0)], "r int, c int, v double")
    assert {x.r: x.vec for x in long_to_dense(df, "r", "c", "v").collect()} == {1: [1.0, 2.0, 3.0], 2: [4.0, 0.0, 5.0]}
    with pytest.raises(Exception):
        long_to_dense(df.union(df.limit(1)), "r", "c", "v").collect()


@pytest.mark.parametrize("p", [0.0, 0.25, 0.6, 0.75, 1.0])
def test_quantile_is_exact(spark, p):
    rnd = np.random.default_rng(2)
    for values in (rnd.normal(size=501), rnd.integers(0, 9, 400).astype(float), np.array([3.0])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(7)
        assert math.isclose(Rel.scalar_quantile(df, "v", p, "q").first().q, np.quantile(values, p), rel_tol=1e-12, abs_tol=1e-12)


def test_running_total_within_groups(spark):
    rows = [(k, i, (7 * i) % 5) for k in (1, 2, 3) for i in range(200 if k == 2 else 9)]
    df = spark.createDataFrame(rows, "k int, i int, n int").repartition(9)
    got = {(r.k, r.i): (r.t, r.pos) for r in Rel.running_total(Rel.running_total(df, [F.col("i").desc()], "n", "t", ["k"]),
                                                               [F.col("i").desc()], None, "pos", ["k"]).collect()}
    for k in (1, 2, 3):
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: -r[1])
        total = 0
        for place, (_, i, n) in enumerate(mine, 1):
            total += n
            assert got[k, i] == (total, place)


@pytest.mark.parametrize("block", [2, 1024])
def test_knn_and_peers_on_the_grid(spark, block, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    rnd = np.random.default_rng(4)
    vec = {i: rnd.normal(size=3).tolist() for i in range(25)}
    df = spark.createDataFrame([(i, v, i % 2) for i, v in vec.items()], "id bigint, vec array<double>, cluster int")
    req = spark.createDataFrame([(i, i) for i in range(10)], "request_id bigint, id bigint")

    def cos(a, b):
        return float(np.dot(vec[a], vec[b]) / np.linalg.norm(vec[a]) / np.linalg.norm(vec[b]))

    got = {(r.request_id, r["rank"]): r.candidate_id for r in N.knn_scan(req, df, df, 4).collect()}
    for q in range(10):
        want = sorted((i for i in vec if i != q), key=lambda i: (-round(cos(q, i), 6), i))[:4]
        assert [got[q, k] for k in range(1, 5)] == want
    users = req.withColumnRenamed("id", "user_id")
    for mode in ("banded", "nearest"):
        quick = {tuple(r) for r in U.chosen_peers(users, df, 3, mode).collect()}
        assert quick == {tuple(r) for r in U.select_peers(U.peer_candidates(users, df), 3, mode).collect()}


def test_knn_lsh_sends_ids_to_the_cells_not_vectors(spark, monkeypatch):
    """An id may have two vectors; a row is copied to every block of its buckets, so it must be narrow."""
    import numpy as np

    from marquee.operators import neighbours as N

    rng = np.random.default_rng(2)
    rows = [(i // 2, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 5)))]
    sent, plain = [], N.cells
    monkeypatch.setattr(N, "cells", lambda s, c, *a: sent.extend([s.columns, c.columns]) or plain(s, c, *a))
    monkeypatch.setattr(N, "LSH_ROWS", 8)
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    found = sorted((r["query_id"], r["candidate_id"], r["similarity"]) for r in N.knn_lsh(df, df, 0.5, bucket_length=50.0).collect())
    assert sent and not any({"vec", "h"} & set(c) for c in sent)
    unit = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows]
    want = sorted((i, j, round(float(v @ w), 6)) for i, v in unit for j, w in unit if i != j and v @ w > 0.5)
    assert len(found) >= 0.8 * len(want) > 0 and {(i, j) for i, j, _ in found} <= {(i, j) for i, j, _ in want}
    assert all(min(abs(s - x) for a, b, x in want if (a, b) == (i, j)) < 1e-5 for i, j, s in found)


def test_neighbour_lists_do_not_broadcast_movies(spark, tmp_path):
    """Names compress well in files: the table's size there says little of its size in memory."""
    from marquee.operators import neighbours as N

    def stored(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    movies = stored("m", [(i, f"title {i}", "a|b") for i in range(9)], "movieId long, title string, genres string")
    vectors = stored("v", [(i, [1.0, float(i)], i % 2) for i in range(8)], "id long, vec array<double>, cluster int")
    requests = stored("r", [(1, 2), (1, 3), (2, 4)], "request_id long, movieId long")
    out = N.content_neighbours(requests, vectors, movies, top_n=3)
    top = [x for x in out._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in x][0]
    for df, joins in ((N.seed_rows(requests, vectors, movies), 1), (N.cluster_candidates(vectors, movies), 1)):
        assert df._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == joins
    assert "SortMergeJoin" in top and {r["request_id"] for r in out.collect()} == {1, 2}


def test_genre_donors_do_not_broadcast_requests(spark, tmp_path):
    from marquee.functions.columns import genre_tokens
    from marquee.operators import models as M

    spark.createDataFrame([(i, "a|b" if i % 2 else "c") for i in range(9)], "movieId long, genres string").write.parquet(f"{tmp_path}/m")
    movies = spark.read.parquet(f"{tmp_path}/m")
    requests = movies.where("movieId > 4").select(F.col("movieId").alias("request_id"), genre_tokens("genres").alias("genres"))
    with_vector = movies.where("movieId < 2").select(F.col("movieId").alias("id"))
    out = M.closest_by_genres(requests, movies, with_vector).where("donor_id IS NOT NULL")  # turns the outer join into an inner one
    joins = [x for x in out._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in x]
    assert "SortMergeJoin" in joins[0]
    assert {(r["request_id"], r["donor_id"], r["overlap"]) for r in out.collect()} == {(i, i % 2, 1 + i % 2) for i in range(5, 9)}
