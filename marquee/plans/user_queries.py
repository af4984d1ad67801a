"""Registered user-side queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import features as Fe
from marquee.operators import neighbours as N
from marquee.operators import users as U
from marquee.operators.pivots import knn_pivots
from marquee.plans.catalog import register
from marquee.sources import fixtures as fx

V = fx.with_views
D = "CAST({} AS DOUBLE)"
_COS = ("CASE WHEN q.nrm = 0 OR p.nrm = 0 THEN CAST(0 AS DOUBLE) "
        "ELSE list_dot_product(q.vec, p.vec) / (q.nrm * p.nrm) END")

# requested users: the app's ids 1, 10, 100 as one request each
_REQ_SQL = "rq AS (SELECT movieId AS request_id, movieId AS user_id FROM seeds)"


def _user_requests(spark):
    return fx.seed_requests(spark).select(F.col("movieId").alias("request_id"), F.col("movieId").alias("user_id"))


_PEER_SQL = f"""uv AS (SELECT id, vec, cluster, sqrt(list_dot_product(vec, vec)) AS nrm FROM user_vectors),
pc AS (SELECT r.request_id, r.user_id, p.id AS peer_id, {_COS} AS sim
       FROM rq r JOIN uv q ON r.user_id = q.id JOIN uv p ON q.cluster = p.cluster AND p.id <> q.id),
bw AS (SELECT w, {D.format('0.01')} + CAST(w AS DOUBLE) * {D.format('0.05')} AS lo FROM range(20) t(w)),
bd AS (SELECT pc.*, CAST(bw.w AS INTEGER) AS band FROM pc JOIN bw ON bw.lo < pc.sim AND pc.sim <= bw.lo + {D.format('0.1')}),
sc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY band, peer_id) AS k FROM bd) WHERE k <= 5),
peers AS (SELECT request_id, user_id, peer_id, round(sim, 6) AS similarity, band,
                 CAST(row_number() OVER (PARTITION BY request_id ORDER BY round(sim, 6) DESC, band, peer_id) AS INTEGER) AS similarity_rank
          FROM sc)"""

_CORATE_SQL = """im AS (SELECT userId, movieId, sum(rating) AS r FROM ratings GROUP BY userId, movieId),
pe AS (SELECT DISTINCT peer_id FROM peers),
dt AS (SELECT pe.peer_id, b.userId AS v, sum(a.r * b.r) AS d FROM pe JOIN im a ON a.userId = pe.peer_id
       JOIN im b ON a.movieId = b.movieId GROUP BY pe.peer_id, b.userId),
sco AS (SELECT dt.peer_id, b.movieId, sum(dt.d * b.r) AS score FROM dt JOIN im b ON dt.v = b.userId GROUP BY dt.peer_id, b.movieId),
uni AS (SELECT DISTINCT movieId FROM im),
allc AS (SELECT pe.peer_id, u.movieId, coalesce(s.score, CAST(0 AS DOUBLE)) AS score FROM pe CROSS JOIN uni u
         LEFT JOIN sco s ON s.peer_id = pe.peer_id AND s.movieId = u.movieId
         WHERE NOT EXISTS (SELECT 1 FROM im WHERE im.userId = pe.peer_id AND im.movieId = u.movieId)),
recs AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY peer_id ORDER BY score DESC, movieId) AS INTEGER) AS item_rank
                        FROM allc) WHERE item_rank <= 100)"""


@register(
    "similarity_bands",
    f"""{V('user_vectors', 'seeds')}, {_REQ_SQL}, {_PEER_SQL}
SELECT request_id, user_id, peer_id, round(sim, 6) AS similarity, band FROM bd""",
)
def similarity_bands(spark, sf_dir):
    """Every (request user, cluster peer) pair with each overlapping window that holds it."""
    c = U.peer_candidates(_user_requests(spark), fx.user_vectors(spark, sf_dir))
    return U.similarity_bands(c).select("request_id", "user_id", "peer_id",
                                        F.round("similarity", 6).alias("similarity"), "band")


@register(
    "peer_selection",
    f"{V('user_vectors', 'seeds')}, {_REQ_SQL}, {_PEER_SQL} SELECT * FROM peers",
)
def peer_selection(spark, sf_dir):
    """R7 step 1 / W4 (parity mode 'banded'): five peers per requested user with similarity rank."""
    return U.select_peers(U.peer_candidates(_user_requests(spark), fx.user_vectors(spark, sf_dir)), 5, "banded")


@register(
    "peer_selection_nearest",
    f"""{V('user_vectors', 'seeds')}, {_REQ_SQL},
uv AS (SELECT id, vec, cluster, sqrt(list_dot_product(vec, vec)) AS nrm FROM user_vectors),
pc AS (SELECT r.request_id, r.user_id, p.id AS peer_id, round({_COS}, 6) AS similarity
       FROM rq r JOIN uv q ON r.user_id = q.id JOIN uv p ON q.cluster = p.cluster AND p.id <> q.id),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, peer_id) AS INTEGER) AS similarity_rank FROM pc)
SELECT request_id, user_id, peer_id, similarity, CAST(NULL AS INTEGER) AS band, similarity_rank FROM rk WHERE similarity_rank <= 5""",
)
def peer_selection_nearest(spark, sf_dir):
    """R7 step 1 (default mode 'nearest'): the five most similar distinct cluster peers."""
    return U.select_peers(U.peer_candidates(_user_requests(spark), fx.user_vectors(spark, sf_dir)), 5, "nearest")


@register(
    "user_dot",
    f"""{V('ratings', 'seeds')},
peers AS (SELECT movieId AS peer_id FROM seeds),
im AS (SELECT userId, movieId, sum(rating) AS r FROM ratings GROUP BY userId, movieId)
SELECT p.peer_id, b.userId AS v, sum(a.r * b.r) AS dot FROM peers p JOIN im a ON a.userId = p.peer_id
JOIN im b ON a.movieId = b.movieId GROUP BY p.peer_id, b.userId""",
)
def user_dot(spark, sf_dir):
    """sparse row dot products of users 1, 10, 100 with every co-rater."""
    peers = fx.seed_requests(spark).select(F.col("movieId").alias("peer_id"))
    return U.user_dot(peers, U.interaction_matrix(fx.ratings(spark, sf_dir)))


@register(
    "co_rating_scores",
    f"""{V('ratings', 'seeds')}, peers AS (SELECT movieId AS peer_id FROM seeds), {_CORATE_SQL}
SELECT peer_id, movieId, score, item_rank FROM recs""",
)
def co_rating_scores(spark, sf_dir):
    """Top-100 unrated items of users 1, 10, 100 by co-rating score."""
    peers = fx.seed_requests(spark).select(F.col("movieId").alias("peer_id"))
    return U.co_rating_scores(peers, fx.ratings(spark, sf_dir), 100)


@register(
    "user_ensemble",
    f"""{V('user_vectors', 'ratings', 'movies', 'seeds')}, {_REQ_SQL}, {_PEER_SQL}, {_CORATE_SQL},
votes AS (SELECT p.request_id, r.movieId, count(*) AS ensemble_score, list_sort(list_distinct(list(p.peer_id))) AS supported_by_users
          FROM peers p JOIN recs r ON p.peer_id = r.peer_id GROUP BY p.request_id, r.movieId),
en AS (SELECT v.*, m.title, m.genres FROM votes v JOIN movies m ON v.movieId = m.movieId),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY ensemble_score DESC, movieId) AS INTEGER) AS rank FROM en)
SELECT request_id, movieId AS movie_id, title, genres, ensemble_score, supported_by_users, rank FROM rk WHERE rank <= 50""",
    headline=True,
)
def user_ensemble(spark, sf_dir):
    """Users 1, 10, 100 -> 5 banded cluster peers -> each peer's top 100 co-rated items -> votes -> top 50."""
    return U.user_ensemble(_user_requests(spark), fx.user_vectors(spark, sf_dir), fx.ratings(spark, sf_dir),
                           fx.movies(spark, sf_dir))


_EVERY_USER_SQL = "rq AS (SELECT DISTINCT id AS request_id, id AS user_id FROM user_vectors)"
_ENSEMBLE_SQL = """votes AS (SELECT p.request_id, r.movieId, count(*) AS ensemble_score, list_sort(list_distinct(list(p.peer_id))) AS supported_by_users
          FROM peers p JOIN recs r ON p.peer_id = r.peer_id GROUP BY p.request_id, r.movieId),
en AS (SELECT v.*, m.title, m.genres FROM votes v JOIN movies m ON v.movieId = m.movieId),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY ensemble_score DESC, movieId) AS INTEGER) AS rank FROM en)
SELECT request_id, movieId AS movie_id, title, genres, ensemble_score, supported_by_users, rank FROM rk WHERE rank <= 50"""


@register(
    "user_ensemble_all_users",
    f"{V('user_vectors', 'ratings', 'movies')}, {_EVERY_USER_SQL}, {_PEER_SQL}, {_CORATE_SQL},\n{_ENSEMBLE_SQL}",
)
def user_ensemble_all_users(spark, sf_dir):
    """R7 + M12 as one batch: every user with a vector."""
    uv = fx.user_vectors(spark, sf_dir)
    req = uv.select(F.col("id").alias("request_id"), F.col("id").alias("user_id")).distinct()
    return U.user_ensemble(req, uv, fx.ratings(spark, sf_dir), fx.movies(spark, sf_dir))


_BUCKET = "('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT % 10"
_HELD_OUT_SQL = f"""tr AS (SELECT id, vec, sqrt(list_dot_product(vec, vec)) AS nrm FROM user_vectors WHERE {_BUCKET} >= 2),
te AS (SELECT id, vec, cluster, sqrt(list_dot_product(vec, vec)) AS nrm FROM user_vectors WHERE {_BUCKET} < 2),
rq AS (SELECT request_id, user_id FROM (SELECT q.id AS request_id, p.id AS user_id,
         row_number() OVER (PARTITION BY q.id ORDER BY round({_COS}, 6) DESC, p.id) AS k FROM tr q CROSS JOIN te p) WHERE k = 1)"""


@register(
    "user_ensemble_heldout",
    f"""{V('user_vectors', 'ratings', 'movies')}, {_HELD_OUT_SQL},
{_PEER_SQL.replace("uv AS (SELECT id, vec, cluster, sqrt(list_dot_product(vec, vec)) AS nrm FROM user_vectors)", "uv AS (SELECT * FROM te)")},
{_CORATE_SQL},
{_ENSEMBLE_SQL}""",
)
def user_ensemble_heldout(spark, sf_dir):
    """R7, second list: for every train user, the ensemble of the most similar held-out user among the held-out users."""
    uv = Fe.row_split(fx.user_vectors(spark, sf_dir), "id")
    train, test = uv.where(F.col("split") == "train"), uv.where(F.col("split") == "test")
    near = knn_pivots(train.select("id", F.col("id").alias("request_id")), train, test, 1, exclude_self=False)
    req = near.select("request_id", F.col("candidate_id").alias("user_id"))
    return U.user_ensemble(req, test.drop("split"), fx.ratings(spark, sf_dir), fx.movies(spark, sf_dir))


@register(
    "ensemble_votes",
    f"""{V('user_vectors', 'ratings', 'movies', 'seeds')}, {_REQ_SQL}, {_PEER_SQL}, {_CORATE_SQL}
SELECT p.request_id, r.movieId AS movie_id, count(*) AS ensemble_score, list_sort(list_distinct(list(p.peer_id))) AS supported_by_users
FROM peers p JOIN recs r ON p.peer_id = r.peer_id GROUP BY p.request_id, r.movieId""",
)
def ensemble_votes(spark, sf_dir):
    """Vote count and distinct supporters per candidate, before the top-n cut."""
    out = U.user_ensemble(_user_requests(spark), fx.user_vectors(spark, sf_dir), fx.ratings(spark, sf_dir),
                          fx.movies(spark, sf_dir), top_n=None)
    return out.select("request_id", "movie_id", "ensemble_score", "supported_by_users")


@register(
    "peer_recommendations",
    f"""{V('user_vectors', 'ratings', 'movies', 'seeds')}, {_REQ_SQL}, {_PEER_SQL}, {_CORATE_SQL}
SELECT p.request_id, p.peer_id AS user_id, r.movieId AS movie_id, m.title, m.genres, p.similarity_rank, r.item_rank
FROM peers p JOIN recs r ON p.peer_id = r.peer_id JOIN movies m ON r.movieId = m.movieId""",
)
def peer_recommendations(spark, sf_dir):
    """R7 side output: per chosen peer, its items with the peer's similarity rank."""
    return U.peer_recommendations(_user_requests(spark), fx.user_vectors(spark, sf_dir), fx.ratings(spark, sf_dir),
                                  fx.movies(spark, sf_dir))


@register(
    "segment_recommend",
    f"""{V('ratings', 'movies', 'user_clusters')},
r AS (SELECT r.*, c.cluster FROM ratings r JOIN user_clusters c ON r.userId = c.user_id),
st AS (SELECT cluster, movieId, avg(rating) AS avg_rating, count(rating) AS rating_count FROM r GROUP BY cluster, movieId),
md AS (SELECT cluster, median(rating_count) AS m FROM st GROUP BY cluster),
sc AS (SELECT st.*, round(rating_count / (rating_count + m) * avg_rating, 6) AS weighted_rating FROM st JOIN md ON st.cluster = md.cluster),
tp AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY cluster ORDER BY weighted_rating DESC, movieId) AS INTEGER) AS rank FROM sc) WHERE rank <= 20)
SELECT u.user_id AS request_id, u.user_id, tp.movieId, m.title, tp.avg_rating, tp.rating_count, tp.weighted_rating, tp.rank
FROM user_clusters u JOIN tp ON u.cluster = tp.cluster JOIN movies m ON tp.movieId = m.movieId""",
    headline=True,
)
def segment_recommend(spark, sf_dir):
    """R11 for every user: the segment's top 20 by shrunk rating (m = median votes in the segment)."""
    uc = fx.user_clusters(spark, sf_dir)
    req = uc.select(F.col("user_id").alias("request_id"), "user_id")
    return U.segment_recommend(req, uc, fx.ratings(spark, sf_dir), fx.movies(spark, sf_dir), 20)


_WATCHED_SQL = """pop AS (SELECT movieId, avg(rating) AS mean_rating, count(rating) AS rating_count FROM ratings GROUP BY movieId),
allm AS (SELECT m.movieId, m.title, coalesce(p.mean_rating, 0) AS mean_rating, coalesce(p.rating_count, 0) AS rating_count
         FROM movies m LEFT JOIN pop p ON m.movieId = p.movieId),
st AS (SELECT avg(mean_rating) AS C, quantile_cont(rating_count, 0.6) AS m FROM allm),
wc AS (SELECT DISTINCT w.request_id, c.cluster FROM w JOIN item_clusters c ON w.movieId = c.movieId),
cand AS (SELECT w2.request_id, a.movieId, a.title, a.mean_rating, a.rating_count,
                round(a.rating_count / (a.rating_count + st.m) * a.mean_rating + st.m / (a.rating_count + st.m) * st.C, 6) AS score
         FROM wc w2 JOIN item_clusters c ON w2.cluster = c.cluster JOIN allm a ON a.movieId = c.movieId, st
         WHERE a.rating_count >= 1 AND NOT EXISTS (SELECT 1 FROM w WHERE w.request_id = w2.request_id AND w.movieId = a.movieId)),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY score DESC, movieId) AS INTEGER) AS rank FROM cand)
SELECT request_id, movieId, title, mean_rating, CAST(rating_count AS BIGINT) AS rating_count, score, rank FROM rk WHERE rank <= 10"""


@register(
    "watched_segments",
    f"{V('ratings', 'movies', 'item_clusters', 'seeds')}, w AS (SELECT request_id, movieId FROM seeds), {_WATCHED_SQL}",
)
def watched_segments(spark, sf_dir):
    """R10 for watched ids 1, 10, 100."""
    return U.watched_segments(fx.seed_requests(spark), fx.item_clusters(spark, sf_dir), fx.movies(spark, sf_dir),
                              fx.ratings(spark, sf_dir), 10)


@register(
    "watched_segments_all_users",
    f"""{V('ratings', 'movies', 'item_clusters')},
w AS (SELECT DISTINCT userId AS request_id, movieId FROM ratings WHERE rating > 3.5), {_WATCHED_SQL}""",
)
def watched_segments_all_users(spark, sf_dir):
    """R10 as one batch: every user's positively rated items are the watched list."""
    req = fx.positive_ratings(spark, sf_dir, 3.5).select(
        F.col("userId").alias("request_id"), "movieId")
    return U.watched_segments(req, fx.item_clusters(spark, sf_dir), fx.movies(spark, sf_dir),
                              fx.ratings(spark, sf_dir), 10)


_ALL_PEERS_SQL = f"""{V('user_vectors', 'seeds')}, {_REQ_SQL},
uv AS (SELECT id, vec, cluster, sqrt(list_dot_product(vec, vec)) AS nrm FROM user_vectors),
pc AS (SELECT r.request_id, r.user_id, p.id AS peer_id, round({_COS}, 6) AS similarity
       FROM rq r JOIN uv q ON r.user_id = q.id JOIN uv p ON q.cluster = p.cluster AND p.id <> q.id)"""


@register(
    "similar_user_rank",
    f"""{_ALL_PEERS_SQL}
SELECT request_id, user_id, peer_id, similarity,
       CAST(row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, peer_id) AS INTEGER) AS similarity_rank FROM pc""",
)
def similar_user_rank(spark, sf_dir):
    """Every cluster peer of users 1, 10, 100 ranked by similarity (row_number per request)."""
    from pyspark.sql import Window

    c = U.peer_candidates(_user_requests(spark), fx.user_vectors(spark, sf_dir)).withColumn(
        "similarity", F.round("similarity", 6))
    w = Window.partitionBy("request_id").orderBy(F.col("similarity").desc(), F.col("peer_id").asc())
    return c.withColumn("similarity_rank", F.row_number().over(w))


@register(
    "similarity_level",
    f"""{_ALL_PEERS_SQL}
SELECT request_id, user_id, peer_id, similarity,
       CASE WHEN similarity = 1.0 THEN 'identical' WHEN similarity > 0.99 THEN 'near identical'
            WHEN similarity > 0.95 THEN 'close' WHEN similarity > 0.90 THEN 'medium' ELSE 'weak' END AS similarity_level
FROM pc""",
)
def similarity_level(spark, sf_dir):
    """level label of every peer similarity of users 1, 10, 100."""
    from marquee.functions.columns import similarity_level as level

    c = U.peer_candidates(_user_requests(spark), fx.user_vectors(spark, sf_dir)).withColumn(
        "similarity", F.round("similarity", 6))
    return c.withColumn("similarity_level", level("similarity"))
