"""User-side queries: co-rating scores (M12), similarity bands (J11), peer
selection (R7), ensemble votes (A9), segment lists (R10, R11).

M12 is kept in long form: dot(u, v) = sum_i r_ui * r_vi by one equi-join on the
item, then score_j = sum_v dot(u, v) * r_vj by a second equi-join on the user.
Both joins start from the requested peers only, so the work is bounded by the
peers' co-rating neighbourhoods, never by all user pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import cosine, norm, shrunk_rating, weighted_rating
from marquee.operators.neighbours import best, cells, cosine_matrix
from marquee.operators.relational import (
    dense_index,
    group_quantile,
    interaction_matrix,
    popularity,
    running_total,
    split_join,
    scalar_quantile,
    top_k_per_group,
    with_scalars,
)
from marquee.session import cut_lineage
from marquee.sources.io import roundtrip_parquet

SCORE_DIGITS = 6

# Peer similarity windows (lower = 0.01 + w * 0.05 for w = 0..19, width 0.10).
BAND_START = 0.01
BAND_STEP = 0.05
BAND_WIDTH = 0.10
BAND_COUNT = 20


def band_lower(w):
    return F.lit(BAND_START) + w.cast("double") * F.lit(BAND_STEP)


def similarity_bands(df: DataFrame, sim: str = "similarity") -> DataFrame:
    """One row per window w with lower_w < sim <= lower_w + width.

    The 1-2 matching windows are computed arithmetically (a slack of one window each
    side, then the exact test), so no range join / nested loop is planned."""
    s = F.col(sim)
    lo = F.greatest(F.floor((s - F.lit(BAND_START + BAND_WIDTH)) / F.lit(BAND_STEP)) - 1, F.lit(0))
    hi = F.least(F.floor((s - F.lit(BAND_START)) / F.lit(BAND_STEP)) + 1, F.lit(BAND_COUNT - 1))
    x = df.withColumn("band", F.explode(F.when(lo <= hi, F.sequence(lo.cast("int"), hi.cast("int")))
                                        .otherwise(F.array().cast("array<int>"))))
    lower = band_lower(F.col("band"))
    return x.where((lower < s) & (s <= lower + F.lit(BAND_WIDTH)))


def _peer_sides(requests: DataFrame, user_vectors: DataFrame):
    q = requests.select("request_id", "user_id").join(
        user_vectors.select(F.col("id").alias("user_id"), F.col("vec").alias("q_vec"), norm("vec").alias("q_nrm"),
                            "cluster"), "user_id")
    c = user_vectors.select(F.col("id").alias("peer_id"), F.col("vec").alias("p_vec"), norm("vec").alias("p_nrm"),
                            "cluster")
    return q, c


def peer_candidates(requests: DataFrame, user_vectors: DataFrame) -> DataFrame:
    """Every cluster member of each requested user with cosine similarity, self excluded."""
    q, c = _peer_sides(requests, user_vectors)
    pairs = q.join(c, "cluster").where(F.col("user_id") != F.col("peer_id"))
    sim = cosine("q_vec", "p_vec", F.col("q_nrm"), F.col("p_nrm"))
    return pairs.select("request_id", "user_id", "peer_id", sim.alias("similarity"))


def _peer_kernel(num_user: int, mode: str):
    """Of a cell, the pairs that can be among a request's peers: its first hits in window and id order, or
    its most similar members."""

    def run(_key, sp: pd.DataFrame, cp: pd.DataFrame) -> pd.DataFrame:
        if sp.empty or cp.empty:
            r = c = np.zeros(0, dtype=int)
            sims = np.zeros((0, 0))
        else:
            cp = cp.sort_values("peer_id")
            sims = cosine_matrix(sp["q_vec"], sp["q_nrm"], cp["p_vec"], cp["p_nrm"])
            usable = sp["user_id"].to_numpy()[:, None] != cp["peer_id"].to_numpy()[None, :]
            if mode == "nearest":
                keep = best(sims, usable, num_user)
            else:
                keep, hits = np.zeros(sims.shape, dtype=bool), np.zeros(len(sp), dtype=int)
                for w in range(BAND_COUNT):  # slack: the exact test follows on the merged rows
                    lower = BAND_START + w * BAND_STEP
                    inside = usable & (sims > lower - 1e-9) & (sims <= lower + BAND_WIDTH + 1e-9)
                    sure = inside & (sims > lower + 1e-9) & (sims <= lower + BAND_WIDTH - 1e-9)
                    before = hits[:, None] + np.cumsum(sure, axis=1) - sure
                    keep |= inside & (before < num_user)
                    hits += sure.sum(axis=1)
            r, c = np.nonzero(keep)
        return pd.DataFrame({"request_id": sp["request_id"].to_numpy()[r], "user_id": sp["user_id"].to_numpy()[r],
                             "peer_id": cp["peer_id"].to_numpy()[c], "similarity": sims[r, c]})

    return run


def chosen_peers(requests: DataFrame, user_vectors: DataFrame, num_user: int = 5, mode: str = "banded") -> DataFrame:
    """R7 peers of every request: the grid cuts each cell to what can be chosen, then ``select_peers``."""
    q, c = cells(*_peer_sides(requests, user_vectors), "peer_id")
    pairs = q.cogroup(c).applyInPandas(
        _peer_kernel(num_user, mode), "request_id bigint, user_id bigint, peer_id bigint, similarity double")
    return select_peers(pairs, num_user, mode)


def select_peers(cands: DataFrame, num_user: int = 5, mode: str = "banded") -> DataFrame:
    """R7 peer choice.

    banded (parity): scan windows from the lowest up, members in id order inside a window,
    keep the first ``num_user`` hits (a peer in two overlapping windows counts twice), then
    order by similarity. nearest: the ``num_user`` most similar distinct peers.
    """
    c = cands.withColumn("sim6", F.round("similarity", SCORE_DIGITS))
    if mode == "banded":
        b = similarity_bands(c)
        first = top_k_per_group(b, ["request_id"], [F.col("band").asc(), F.col("peer_id").asc()], num_user, "_scan")
        order = [F.col("sim6").desc(), F.col("band").asc(), F.col("peer_id").asc()]
    elif mode == "nearest":
        first = c.withColumn("band", F.lit(None).cast("int"))
        order = [F.col("sim6").desc(), F.col("peer_id").asc()]
    else:
        raise ValueError(mode)
    ranked = top_k_per_group(first, ["request_id"], order, num_user, "similarity_rank")
    return ranked.select("request_id", "user_id", "peer_id", F.col("sim6").alias("similarity"), "band",
                         "similarity_rank")


def _peer_rows(peers: DataFrame, matrix: DataFrame) -> DataFrame:
    u = peers.select("peer_id").distinct()
    return matrix.join(u, matrix.userId == u.peer_id).select("peer_id", "movieId", F.col("rating").alias("r_u"))


def user_dot(peers: DataFrame, matrix: DataFrame, mine: DataFrame | None = None) -> DataFrame:
    """dot(u, v) = sum_i r_ui r_vi for every requested u and every co-rater v."""
    mine = _peer_rows(peers, matrix) if mine is None else mine
    other = matrix.select(F.col("userId").alias("v"), "movieId", F.col("rating").alias("r_v"))
    return split_join(mine, other, "movieId", "v").groupBy("peer_id", "v").agg(F.sum(F.col("r_u") * F.col("r_v")).alias("dot"))


def co_rating_scores(peers: DataFrame, ratings: DataFrame, top_n: int = 100) -> DataFrame:
    """For each peer u, unrated items j scored by sum_v dot(u, v) * r_vj; top n (ties: id).

    Items no co-rater reached score 0; they fill the list in id order when fewer than n items are reached.
    The matrix is written once and read by all branches. It is multiplied in two keyed joins whose heavy items and
    heavy co-raters are cut into parts, with partial sums; only lists of n leave the product, and only peers whose
    lists are short are joined with the item dictionary."""
    m = cut_lineage(interaction_matrix(ratings))
    mine = _peer_rows(peers, m)
    d = user_dot(peers, m, mine)
    other = m.select(F.col("userId").alias("v"), "movieId", F.col("rating").alias("r_v"))
    rated = mine.select("peer_id", "movieId")
    scored = split_join(d, other, "v", "movieId").groupBy("peer_id", "movieId").agg(F.sum(F.col("dot") * F.col("r_v")).alias("score"))
    scored = scored.join(rated, ["peer_id", "movieId"], "left_anti")
    order = [F.col("score").desc(), F.col("movieId").asc()]
    top = cut_lineage(top_k_per_group(scored, ["peer_id"], order, top_n, "item_rank"))

    # zero-score fill: a short list holds all that its peer reaches; the smallest other ids follow
    lengths = top.groupBy("peer_id").agg(F.count(F.lit(1)).alias("n_scored")).where(F.col("n_scored") >= top_n)
    short = peers.select("peer_id").distinct().join(lengths, "peer_id", "left_anti")
    if short.isEmpty():
        return top
    found = top.join(short, "peer_id", "left_semi").drop("item_rank")
    taken = found.select("peer_id", "movieId").unionByName(rated.join(short, "peer_id", "left_semi")).distinct()
    slots = short.join(taken.groupBy("peer_id").agg(F.count(F.lit(1)).alias("n_taken")), "peer_id", "left").select(
        "peer_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("n_taken", F.lit(0)) + top_n - 1)).alias("idx"))
    fill = slots.join(dense_index(m.select("movieId"), "movieId", "idx"), "idx").select("peer_id", "movieId")
    fill = fill.join(taken, ["peer_id", "movieId"], "left_anti").withColumn("score", F.lit(0.0))
    filled = top_k_per_group(found.unionByName(fill), ["peer_id"], order, top_n, "item_rank")
    return top.join(short, "peer_id", "left_anti").unionByName(filled)


def user_ensemble(requests: DataFrame, user_vectors: DataFrame, ratings: DataFrame, movies: DataFrame, *,
                  top_n: int | None = 50, num_user: int = 5, per_peer: int = 100, mode: str = "banded") -> DataFrame:
    """Peers -> each peer's top co-rated items -> votes per item -> top n (None: all votes, unranked).

    ensemble_score counts peer occurrences (parity: a peer chosen twice votes twice);
    supported_by_users is the sorted distinct peer list. The peers (at most ``num_user`` a request)
    feed three branches, so they are written once."""
    peers = cut_lineage(chosen_peers(requests, user_vectors, num_user, mode))
    recs = co_rating_scores(peers.select("peer_id").distinct(), ratings, per_peer)
    votes = peers.select("request_id", "peer_id").join(recs.select("peer_id", "movieId"), "peer_id")
    agg = votes.groupBy("request_id", "movieId").agg(
        F.count(F.lit(1)).alias("ensemble_score"), F.sort_array(F.collect_set("peer_id")).alias("supported_by_users"))
    agg = agg.join(movies.select("movieId", "title", "genres"), "movieId").withColumnRenamed("movieId", "movie_id")
    if top_n is None:
        return agg.select("request_id", "movie_id", "title", "genres", "ensemble_score", "supported_by_users")
    top = top_k_per_group(agg, ["request_id"], [F.col("ensemble_score").desc(), F.col("movie_id").asc()], top_n)
    return top.select("request_id", "movie_id", "title", "genres", "ensemble_score", "supported_by_users", "rank")


def peer_recommendations(requests: DataFrame, user_vectors: DataFrame, ratings: DataFrame, movies: DataFrame, *,
                         num_user: int = 5, per_peer: int = 100, mode: str = "banded") -> DataFrame:
    """R7 side output: each chosen peer's list with its similarity rank."""
    peers = cut_lineage(chosen_peers(requests, user_vectors, num_user, mode))
    recs = co_rating_scores(peers.select("peer_id").distinct(), ratings, per_peer)
    out = peers.join(recs, "peer_id").join(movies.select("movieId", "title", "genres"), "movieId")
    return out.select("request_id", F.col("peer_id").alias("user_id"), F.col("movieId").alias("movie_id"), "title",
                      "genres", "similarity_rank", "item_rank")


def segment_recommend(requests: DataFrame, user_clusters: DataFrame, ratings: DataFrame, movies: DataFrame,
                      top_n: int = 20) -> DataFrame:
    """Per user segment: stats of the members' ratings, m = median votes, v/(v+m)*R, top n.

    The list depends only on the segment, so it is computed once per segment and joined to
    the requested users (unknown users drop out; see ``unknown_users``). The stats are written once;
    medians are order statistics over ranges, so no task holds a segment."""
    r = ratings.join(user_clusters.select(F.col("user_id").alias("userId"), "cluster"), "userId")
    stats = cut_lineage(r.groupBy("cluster", "movieId").agg(F.avg("rating").alias("avg_rating"),
                                                            F.count("rating").alias("rating_count")))
    med = group_quantile(stats, ["cluster"], "rating_count", 0.5, "_m")
    scored = stats.join(F.broadcast(med), "cluster").withColumn(
        "weighted_rating", F.round(shrunk_rating("rating_count", "avg_rating", "_m"), SCORE_DIGITS))
    top = top_k_per_group(scored, ["cluster"], [F.col("weighted_rating").desc(), F.col("movieId").asc()], top_n)
    top = top.join(movies.select("movieId", "title"), "movieId")
    req = requests.select("request_id", "user_id").join(user_clusters, "user_id")
    return req.join(top, "cluster").select("request_id", "user_id", "movieId", "title", "avg_rating",
                                           "rating_count", "weighted_rating", "rank")


def watched_segments(requests: DataFrame, item_clusters: DataFrame, movies: DataFrame, ratings: DataFrame,
                     top_k: int = 10, quantile: float = 0.60) -> DataFrame:
    """Unwatched movies from the clusters of the watched ones, count >= 1, scored by the
    weighted rating (C = mean over all movies incl. unrated 0s, m = q0.60 of counts), top k.

    The score does not depend on the request, so each cluster is ranked once. A request needs only
    its clusters' first k entries whose ranks are not those of watched movies: k ids and scores a
    cluster are sorted per request, and titles are joined to the k that are left."""
    pop = popularity(ratings, mean_name="mean_rating", count_name="rating_count")
    allm = movies.select("movieId", "title").join(pop, "movieId", "left").na.fill(
        {"mean_rating": 0.0, "rating_count": 0})
    stats = allm.agg(F.avg("mean_rating").alias("_C")).crossJoin(scalar_quantile(allm, "rating_count", quantile, "_m"))
    scored = with_scalars(allm.join(item_clusters, "movieId"), stats).where(F.col("rating_count") >= 1)
    scored = scored.withColumn(
        "score", F.round(weighted_rating("rating_count", "mean_rating", "_m", "_C"), SCORE_DIGITS))
    ranked = roundtrip_parquet(running_total(scored, [F.col("score").desc(), F.col("movieId").asc()],
                                             None, "crank", ["cluster"]), "cluster-ranks")
    watched = requests.select("request_id", "movieId").distinct().join(item_clusters, "movieId")
    seen = watched.join(ranked.select("movieId", "cluster", "crank"), ["movieId", "cluster"], "left")
    seen = seen.groupBy("request_id", "cluster").agg(F.collect_set(F.when(F.col("request_id").isNotNull(), F.col("crank"))).alias("_seen"))
    free = F.slice(F.array_except(F.sequence(F.lit(1).cast("bigint"), F.size("_seen") + F.lit(top_k).cast("bigint")), "_seen"), 1, top_k)
    slots = cut_lineage(seen.select("request_id", "cluster", free.alias("_free")))
    last = slots.agg(F.max(F.element_at("_free", -1)).alias("_last"))  # no request looks beyond it
    wanted = roundtrip_parquet(with_scalars(ranked, last).where(F.col("crank") <= F.col("_last")).drop("_last"), "wanted-ranks")
    cand = slots.select("request_id", "cluster", F.explode("_free").alias("crank")).join(
        wanted.select("cluster", "crank", "movieId", "score"), ["cluster", "crank"])
    top = top_k_per_group(cand, ["request_id"], [F.col("score").desc(), F.col("movieId").asc()], top_k)
    top = top.join(wanted.select("cluster", "crank", "title", "mean_rating", "rating_count"), ["cluster", "crank"])
    return top.select("request_id", "movieId", "title", "mean_rating", "rating_count", "score", "rank")

