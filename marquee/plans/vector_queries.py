"""Registered vector/similarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import columns as C
from marquee.operators import features as Fe
from marquee.operators import neighbours as N
from marquee.operators import recommend as R
from marquee.operators import vectors as Vec
from marquee.operators.pivots import PivotSearch, knn_pivots
from marquee.plans.catalog import register
from marquee.sources import fixtures as fx

V = fx.with_views
_HASH = "('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8))::BIGINT % 10"
ZERO = "CAST(0 AS DOUBLE)"
COS = ("CASE WHEN {a}n = 0 OR {b}n = 0 THEN " + ZERO +
       " ELSE list_dot_product({a}, {b}) / ({a}n * {b}n) END")
WEIGHT = ("CASE WHEN n <= 1 THEN CAST(20 AS DOUBLE) ELSE "
          "round_even(CAST(rank - 1 AS DOUBLE) * (CAST(-19 AS DOUBLE) / CAST(n - 1 AS DOUBLE)) + CAST(20 AS DOUBLE), 0) END")


def _vec_sql(name: str = "item_vectors", where: str = "") -> str:
    return f"SELECT id, vec, cluster, sqrt(list_dot_product(vec, vec)) AS nrm FROM {name} {where}"


def _neighbours_sql(requests_cte: str, *, vec_where: str = "", gate: bool = True, exclude_seeds: bool = False,
                    blocked: bool = False, top_n: int = 50, vec_source: str | None = None,
                    views=("item_vectors", "movies", "seeds")) -> str:
    sim = COS.format(a="s.svec", b="c.cvec").replace("s.svecn", "s.svn").replace("c.cvecn", "c.cvn")
    if gate:
        sim = f"CASE WHEN NOT list_has_any(s.sg, c.cg) THEN {ZERO} ELSE {sim} END"
    vsrc = vec_source or _vec_sql("item_vectors", vec_where)
    excl = ""
    if blocked:
        excl += " AND movie_id NOT IN (SELECT movieId FROM (SELECT movieId, arg_max(importance_score, seq) AS s FROM importance GROUP BY movieId) WHERE s = -1)"
    if exclude_seeds:
        excl += " AND NOT EXISTS (SELECT 1 FROM req q WHERE q.request_id = ag.request_id AND q.movieId = ag.movie_id)"
    return f"""{V(*views)},
req AS ({requests_cte}),
vn AS ({vsrc}),
sd AS (SELECT q.request_id, q.movieId AS seed_id, v.vec AS svec, v.nrm AS svn, v.cluster, string_split(m.genres, '|') AS sg
       FROM req q JOIN vn v ON q.movieId = v.id JOIN movies m ON m.movieId = q.movieId),
cd AS (SELECT v.id AS movie_id, v.vec AS cvec, v.nrm AS cvn, v.cluster, m.title, m.genres, string_split(m.genres, '|') AS cg
       FROM vn v JOIN movies m ON v.id = m.movieId WHERE m.title IS NOT NULL AND m.genres IS NOT NULL),
pr AS (SELECT s.request_id, c.movie_id, c.title, c.genres, {sim} AS sim
       FROM sd s JOIN cd c ON s.cluster = c.cluster AND s.seed_id <> c.movie_id),
ag AS (SELECT request_id, movie_id, title, genres, round(sum(sim), 6) AS similarity_score FROM pr GROUP BY ALL),
fl AS (SELECT * FROM ag WHERE TRUE{excl}),
rk AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY similarity_score DESC, movie_id) AS rank FROM fl),
tp AS (SELECT *, count(*) OVER (PARTITION BY request_id) AS n FROM rk WHERE rank <= {top_n})
SELECT request_id, movie_id, title, genres, similarity_score, {WEIGHT} AS weight, CAST(rank AS INTEGER) AS rank FROM tp"""


_SEEDS = "SELECT request_id, movieId FROM seeds"
_USER_SEEDS = ("SELECT r.userId AS request_id, r.movieId FROM (SELECT DISTINCT userId, movieId FROM ratings WHERE rating > 3.5) r "
               "WHERE r.movieId IN (SELECT id FROM item_vectors)")


def _seeds(spark):
    return fx.seed_requests(spark)


def _user_seed_requests(spark, sf_dir):
    """Every user's positively rated items that have a content vector, one request per user."""
    r = fx.positive_ratings(spark, sf_dir, 3.5).select(F.col("userId").alias("request_id"), "movieId").distinct()
    return r.join(fx.item_vectors(spark, sf_dir).select(F.col("id").alias("movieId")), "movieId", "left_semi")


@register("content_neighbours", _neighbours_sql(_SEEDS), headline=True)
def content_neighbours(spark, sf_dir):
    """R2: watched ids 1, 10, 100 -> top 50 cluster neighbours (genre gate, weights)."""
    return N.content_neighbours(_seeds(spark), fx.item_vectors(spark, sf_dir), fx.movies(spark, sf_dir))


@register("content_neighbours_all_users",
          _neighbours_sql(_USER_SEEDS, views=("item_vectors", "movies", "ratings"), top_n=20))
def content_neighbours_all_users(spark, sf_dir):
    """R2 as one batch job: every user is a request whose seeds are their positively rated items."""
    return N.content_neighbours(_user_seed_requests(spark, sf_dir), fx.item_vectors(spark, sf_dir),
                                fx.movies(spark, sf_dir), top_n=20)


@register(
    "seed_info",
    f"""{V('movies', 'seeds')} SELECT s.request_id, m.movieId AS movie_id, m.title,
list_sort(list_distinct(string_split(m.genres, '|'))) AS genre_set FROM seeds s JOIN movies m ON s.movieId = m.movieId""",
)
def seed_info(spark, sf_dir):
    return N.seed_info(_seeds(spark), fx.movies(spark, sf_dir))


@register("content_with_block",
          _neighbours_sql(_SEEDS, blocked=True, top_n=15, views=("item_vectors", "movies", "seeds", "importance")))
def content_with_block(spark, sf_dir):
    """Blocked ids removed before the top-15 cut (promoted list: ``promoted_items``)."""
    return N.content_neighbours(_seeds(spark), fx.item_vectors(spark, sf_dir), fx.movies(spark, sf_dir), top_n=15,
                                blocked=R.blocked_ids(fx.importance(spark, sf_dir)))


def _train_vectors(spark, sf_dir, split="train"):
    iv = fx.item_vectors(spark, sf_dir)
    return Fe.row_split(iv, "id").where(F.col("split") == split).drop("split")


_ID_BUCKET = _HASH.format(k="id")


@register("content_split", " UNION ALL ".join(
    f"SELECT *, '{part}' AS split FROM ({_neighbours_sql(_SEEDS, vec_where=f'WHERE {_ID_BUCKET} {side}')})"
    for part, side in (("train", ">= 2"), ("test", "< 2"))))
def content_split(spark, sf_dir):
    """R2 on the train rows and on the test rows of a keyed 80/20 item split."""
    lists = [N.content_neighbours(_seeds(spark), _train_vectors(spark, sf_dir, part), fx.movies(spark, sf_dir)).withColumn(
        "split", F.lit(part)) for part in ("train", "test")]
    return lists[0].unionByName(lists[1])


@register(
    "union_vectors",
    f"""{V('item_vectors')} SELECT id, cluster, 'train' AS part FROM item_vectors WHERE {_HASH.format(k='id')} >= 2
UNION ALL SELECT id, cluster, 'test' AS part FROM item_vectors WHERE {_HASH.format(k='id')} < 2""",
)
def union_vectors(spark, sf_dir):
    """Keyed union of the train and test vector sets (no positional concat)."""
    tr = _train_vectors(spark, sf_dir, "train").select("id", "cluster", F.lit("train").alias("part"))
    te = _train_vectors(spark, sf_dir, "test").select("id", "cluster", F.lit("test").alias("part"))
    return tr.unionByName(te)


@register("content_neighbours_combined", _neighbours_sql(_SEEDS))
def content_neighbours_combined(spark, sf_dir):
    """R2 on train U test vectors (keyed union)."""
    tr = _train_vectors(spark, sf_dir, "train")
    te = _train_vectors(spark, sf_dir, "test")
    return N.content_neighbours(_seeds(spark), tr.unionByName(te), fx.movies(spark, sf_dir))


_HYBRID_SQL = f"""SELECT v.id, list_concat(v.vec, sc.s) AS vec, v.cluster, sqrt(list_dot_product(list_concat(v.vec, sc.s), list_concat(v.vec, sc.s))) AS nrm
FROM item_vectors v JOIN (
  SELECT l.id, list((l.x - st.mn) / CASE WHEN st.mx - st.mn = 0 THEN CAST(1 AS DOUBLE) ELSE st.mx - st.mn END ORDER BY l.pos) AS s
  FROM (SELECT id, unnest(range(len(vec))) AS pos, unnest(vec) AS x FROM item_vectors) l
  JOIN (SELECT pos, min(x) AS mn, max(x) AS mx FROM (SELECT unnest(range(len(vec))) AS pos, unnest(vec) AS x FROM item_vectors) GROUP BY pos) st
  ON l.pos = st.pos GROUP BY l.id) sc ON v.id = sc.id"""


def _hybrid_vectors(spark, sf_dir):
    iv = fx.item_vectors(spark, sf_dir)
    scaled = Vec.minmax_scale(iv).select("id", F.col("scaled").alias("vec"))
    return Vec.concat_vectors(iv, scaled).join(iv.select("id", "cluster"), "id")


@register("hybrid_neighbours",
          _neighbours_sql(_SEEDS, exclude_seeds=True, blocked=True, vec_source=_HYBRID_SQL,
                          views=("item_vectors", "movies", "seeds", "importance")))
def hybrid_neighbours(spark, sf_dir):
    """Neighbours on hybrid vectors (content || second block); seeds and blocked ids excluded."""
    return N.content_neighbours(_seeds(spark), _hybrid_vectors(spark, sf_dir), fx.movies(spark, sf_dir),
                                exclude_seeds=True, blocked=R.blocked_ids(fx.importance(spark, sf_dir)))


@register("new_item_neighbours", _neighbours_sql(_SEEDS, gate=False, exclude_seeds=True))
def new_item_neighbours(spark, sf_dir):
    """R6 scoring: cluster mates by cosine, no genre gate, seeds excluded."""
    return N.content_neighbours(_seeds(spark), fx.item_vectors(spark, sf_dir), fx.movies(spark, sf_dir),
                                gate=False, exclude_seeds=True)


def _pairs_sql(gate: bool) -> str:
    sim = COS.format(a="s.svec", b="c.cvec").replace("s.svecn", "s.svn").replace("c.cvecn", "c.cvn")
    if gate:
        sim = f"CASE WHEN NOT list_has_any(s.sg, c.cg) THEN {ZERO} ELSE {sim} END"
    return f"""{V('item_vectors', 'movies', 'seeds')},
vn AS ({_vec_sql()}),
sd AS (SELECT q.request_id, q.movieId AS seed_id, v.vec AS svec, v.nrm AS svn, v.cluster, string_split(m.genres, '|') AS sg
       FROM seeds q JOIN vn v ON q.movieId = v.id JOIN movies m ON m.movieId = q.movieId),
cd AS (SELECT v.id AS movie_id, v.vec AS cvec, v.nrm AS cvn, v.cluster, string_split(m.genres, '|') AS cg
       FROM vn v JOIN movies m ON v.id = m.movieId WHERE m.title IS NOT NULL AND m.genres IS NOT NULL)
SELECT s.request_id, s.seed_id, c.movie_id, c.cluster, round({sim}, 6) AS similarity
FROM sd s JOIN cd c ON s.cluster = c.cluster AND s.seed_id <> c.movie_id"""


@register("same_cluster_pairs", _pairs_sql(False))
def same_cluster_pairs(spark, sf_dir):
    """J10 + F11: seed x cluster-mate cosine, seed excluded."""
    p = N.same_cluster_pairs(_seeds(spark), fx.item_vectors(spark, sf_dir), fx.movies(spark, sf_dir))
    return p.select("request_id", "seed_id", "movie_id", "cluster", F.round("similarity", 6).alias("similarity"))


@register("genre_gate", _pairs_sql(True))
def genre_gate(spark, sf_dir):
    """pairs sharing no genre score 0 (kept)."""
    p = N.same_cluster_pairs(_seeds(spark), fx.item_vectors(spark, sf_dir), fx.movies(spark, sf_dir))
    return p.select("request_id", "seed_id", "movie_id", "cluster", F.round("gated", 6).alias("similarity"))


@register(
    "genre_subset",
    f"""{V('movies', 'seeds')},
sg AS (SELECT s.request_id, string_split(m.genres, '|') AS g FROM seeds s JOIN movies m ON s.movieId = m.movieId)
SELECT sg.request_id, m.movieId FROM sg JOIN movies m ON
  len(list_filter(string_split(m.genres, '|'), lambda x: NOT list_contains(sg.g, x))) = 0""",
)
def genre_subset(spark, sf_dir):
    """movies whose genre set is a subset of a seed's genres: an equi-join on the token, where
    as many distinct tokens must match as the movie has."""
    mv = fx.movies(spark, sf_dir).select("movieId", F.array_distinct(C.genre_tokens("genres")).alias("g"))
    sd = _seeds(spark).join(mv, "movieId").select("request_id", F.col("movieId").alias("seed_id"), F.explode("g").alias("token"))
    tokens = mv.select("movieId", F.size("g").alias("n"), F.explode("g").alias("token"))
    hits = tokens.join(sd, "token").groupBy("request_id", "seed_id", "movieId", "n").agg(F.count(F.lit(1)).alias("hits"))
    return hits.where(F.col("hits") == F.col("n")).select("request_id", "movieId")


@register(
    "seed_cosine_all",
    f"""{V('item_vectors', 'seeds')},
vn AS ({_vec_sql()})
SELECT s.request_id, s.movieId AS query_id, c.id AS candidate_id,
       round({COS.format(a='q.vec', b='c.vec').replace('q.vecn', 'q.nrm').replace('c.vecn', 'c.nrm')}, 6) AS similarity
FROM seeds s JOIN vn q ON s.movieId = q.id CROSS JOIN vn c WHERE c.id <> q.id""",
)
def seed_cosine_all(spark, sf_dir):
    """Each request seed against every vector."""
    iv = fx.item_vectors(spark, sf_dir)
    rq = _seeds(spark).select("request_id", F.col("movieId").alias("id"))
    return N.cosine_pairs(rq, iv, iv)


@register(
    "knn_cosine",
    f"""{V('item_vectors', 'seeds')},
vn AS ({_vec_sql()}),
sc AS (SELECT s.movieId AS request_id, q.id AS query_id, c.id AS candidate_id,
              round({COS.format(a='q.vec', b='c.vec').replace('q.vecn', 'q.nrm').replace('c.vecn', 'c.nrm')}, 6) AS similarity
       FROM seeds s JOIN vn q ON s.movieId = q.id CROSS JOIN vn c WHERE c.id <> q.id),
rk AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, candidate_id) AS rank FROM sc)
SELECT request_id, query_id, candidate_id, similarity, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 10""",
)
def knn_cosine(spark, sf_dir):
    """Exact 10 nearest items by cosine per request (per-request top-k)."""
    iv = fx.item_vectors(spark, sf_dir)
    rq = fx.seed_requests(spark).select(F.col("movieId").alias("id")).withColumn("request_id", F.col("id"))
    return N.knn_scan(rq, iv, iv, k=10)


_USER_SPLIT = _HASH.format(k="id")


@register(
    "similar_users",
    f"""{V('user_vectors', 'seeds')},
tr AS (SELECT id, vec, sqrt(list_dot_product(vec, vec)) AS nrm FROM user_vectors WHERE {_USER_SPLIT} >= 2),
te AS (SELECT id, vec, sqrt(list_dot_product(vec, vec)) AS nrm FROM user_vectors WHERE {_USER_SPLIT} < 2),
sc AS (SELECT s.movieId AS request_id, q.id AS train_user_id, c.id AS test_user_id,
              round({COS.format(a='q.vec', b='c.vec').replace('q.vecn', 'q.nrm').replace('c.vecn', 'c.nrm')}, 6) AS similarity
       FROM seeds s JOIN tr q ON s.movieId = q.id CROSS JOIN te c),
rk AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, test_user_id) AS rank FROM sc)
SELECT request_id, train_user_id, test_user_id, similarity,
       CASE WHEN similarity = 1.0 THEN 'identical' WHEN similarity > 0.99 THEN 'near identical'
            WHEN similarity > 0.95 THEN 'close' WHEN similarity > 0.90 THEN 'medium' ELSE 'weak' END AS similarity_level,
       CAST(rank AS INTEGER) AS rank
FROM rk WHERE rank <= 10""",
)
def similar_users(spark, sf_dir):
    """For train users 1, 10, 100 (when in the train split) the 10 most similar test users."""
    uv = Fe.row_split(fx.user_vectors(spark, sf_dir), "id")
    tr = uv.where(F.col("split") == "train")
    te = uv.where(F.col("split") == "test")
    rq = fx.seed_requests(spark).select(F.col("movieId").alias("id")).withColumn("request_id", F.col("id"))
    return N.similar_users(rq, tr, te, 10)


@register(
    "nearest_in_cluster",
    f"""{V('item_vectors', 'seeds')},
tr AS (SELECT id, vec, cluster FROM item_vectors WHERE {_HASH.format(k='id')} >= 2),
te AS (SELECT id, vec, cluster, sqrt(list_dot_product(vec, vec)) AS nrm FROM item_vectors WHERE {_HASH.format(k='id')} < 2),
q AS (SELECT s.movieId AS request_id, t.id AS query_id, t.vec, t.cluster, sqrt(list_dot_product(t.vec, t.vec)) AS nrm
      FROM seeds s JOIN tr t ON s.movieId = t.id),
sc AS (SELECT q.request_id, q.query_id, c.id AS candidate_id,
              round({COS.format(a='q.vec', b='c.vec').replace('q.vecn', 'q.nrm').replace('c.vecn', 'c.nrm')}, 6) AS similarity
       FROM q JOIN te c ON q.cluster = c.cluster AND q.query_id <> c.id),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, candidate_id) AS rn FROM sc) WHERE rn = 1)
SELECT q.request_id, q.query_id, best.candidate_id, best.similarity FROM q LEFT JOIN best ON q.request_id = best.request_id""",
)
def nearest_in_cluster(spark, sf_dir):
    """Nearest test item inside the train item's cluster."""
    iv = Fe.row_split(fx.item_vectors(spark, sf_dir), "id")
    rq = fx.seed_requests(spark).select(F.col("movieId").alias("id")).withColumn("request_id", F.col("id"))
    return N.nearest_in_cluster(rq, iv.where(F.col("split") == "train"), iv.where(F.col("split") == "test"))


@register(
    "sample_nearest",
    f"""{V('item_vectors')},
tr AS (SELECT id, vec, sqrt(list_dot_product(vec, vec)) AS nrm FROM item_vectors WHERE {_HASH.format(k='id')} >= 2),
te AS (SELECT id, vec, sqrt(list_dot_product(vec, vec)) AS nrm FROM item_vectors WHERE {_HASH.format(k='id')} < 2),
smp AS (SELECT * FROM tr ORDER BY md5(CAST(id AS VARCHAR) || ':sample'), id LIMIT 3),
sc AS (SELECT q.id AS request_id, q.id AS query_id, c.id AS candidate_id,
              round({COS.format(a='q.vec', b='c.vec').replace('q.vecn', 'q.nrm').replace('c.vecn', 'c.nrm')}, 6) AS similarity
       FROM smp q CROSS JOIN te c WHERE q.id <> c.id),
rk AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, candidate_id) AS rank FROM sc)
SELECT request_id, query_id, candidate_id, similarity FROM rk WHERE rank = 1""",
)
def sample_nearest(spark, sf_dir):
    """A deterministic hash sample of 3 train items, nearest test item of each (no cluster limit)."""
    iv = Fe.row_split(fx.item_vectors(spark, sf_dir), "id")
    tr = iv.where(F.col("split") == "train")
    te = iv.where(F.col("split") == "test")
    smp = tr.orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit(":sample"))), "id").limit(3)
    rq = smp.select("id", F.col("id").alias("request_id"))
    return N.knn_scan(rq, tr, te, k=1).drop("rank")


@register(
    "user_item_pairs",
    f"""{V('user_vectors', 'item_vectors', 'seeds')}
SELECT s.movieId AS userId, i.id AS movieId, list_concat(u.vec, i.vec) AS features
FROM seeds s JOIN user_vectors u ON s.movieId = u.id CROSS JOIN item_vectors i""",
)
def user_item_pairs(spark, sf_dir):
    """Each requested user's vector paired with every item vector (pair features for scoring).
    All pairs are the result."""
    uv = fx.user_vectors(spark, sf_dir).select(F.col("id").alias("userId"), F.col("vec").alias("u"))
    req = fx.seed_requests(spark).select(F.col("movieId").alias("userId")).join(uv, "userId")
    iv = fx.item_vectors(spark, sf_dir).select(F.col("id").alias("movieId"), F.col("vec").alias("i"))
    return req.crossJoin(iv).select("userId", "movieId", F.concat("u", "i").alias("features"))


@register(
    "sum_similarity",
    f"""{V('item_vectors', 'movies', 'seeds')},
vn AS ({_vec_sql()}),
sd AS (SELECT q.request_id, q.movieId AS seed_id, v.vec AS svec, v.nrm AS svn, v.cluster, string_split(m.genres, '|') AS sg
       FROM seeds q JOIN vn v ON q.movieId = v.id JOIN movies m ON m.movieId = q.movieId),
cd AS (SELECT v.id AS movie_id, v.vec AS cvec, v.nrm AS cvn, v.cluster, string_split(m.genres, '|') AS cg
       FROM vn v JOIN movies m ON v.id = m.movieId WHERE m.title IS NOT NULL AND m.genres IS NOT NULL)
SELECT s.request_id, c.movie_id,
       round(sum(CASE WHEN NOT list_has_any(s.sg, c.cg) THEN {ZERO} ELSE {COS.format(a='s.svec', b='c.cvec').replace('s.svecn', 's.svn').replace('c.cvecn', 'c.cvn')} END), 6) AS similarity_score,
       round(sum({COS.format(a='s.svec', b='c.cvec').replace('s.svecn', 's.svn').replace('c.cvecn', 'c.cvn')}), 6) AS cosine_sum,
       round(sum(1 - {COS.format(a='s.svec', b='c.cvec').replace('s.svecn', 's.svn').replace('c.cvecn', 'c.cvn')}), 6) AS distance_sum
FROM sd s JOIN cd c ON s.cluster = c.cluster AND s.seed_id <> c.movie_id GROUP BY s.request_id, c.movie_id""",
)
def sum_similarity(spark, sf_dir):
    """A8 (+F14): per request and candidate, the gated similarity sum over seeds, the ungated
    cosine sum and the cosine-distance sum (1 - cos), before any cut."""
    iv, mv = fx.item_vectors(spark, sf_dir), fx.movies(spark, sf_dir)
    p = N.same_cluster_pairs(_seeds(spark), iv, mv)
    return p.groupBy("request_id", "movie_id").agg(
        F.round(F.sum("gated"), 6).alias("similarity_score"), F.round(F.sum("similarity"), 6).alias("cosine_sum"),
        F.round(F.sum(1 - F.col("similarity")), 6).alias("distance_sum"))


@register(
    "cosine",
    f"""{V('item_vectors')},
l AS (SELECT id, cluster, unnest(range(len(vec))) AS pos, unnest(vec) AS x FROM item_vectors),
cen AS (SELECT cluster, list(m ORDER BY pos) AS c FROM (SELECT cluster, pos, avg(x) AS m FROM l GROUP BY cluster, pos) GROUP BY cluster),
j AS (SELECT v.id, v.cluster, v.vec, c.c, sqrt(list_dot_product(v.vec, v.vec)) AS vn, sqrt(list_dot_product(c.c, c.c)) AS cn
      FROM item_vectors v JOIN cen c ON v.cluster = c.cluster)
SELECT id, cluster, round(CASE WHEN vn = 0 OR cn = 0 THEN {ZERO} ELSE list_dot_product(vec, c) / (vn * cn) END, 6) AS similarity FROM j""",
)
def cosine(spark, sf_dir):
    """cosine of every item vector with its cluster centroid (0 when a norm is 0)."""
    from marquee.operators import clustering as Cl

    iv = fx.item_vectors(spark, sf_dir)
    cents = Cl.centroids(iv).select("cluster", "centroid")
    j = iv.join(F.broadcast(cents), "cluster")
    return j.select("id", "cluster", F.round(C.cosine("vec", "centroid"), 6).alias("similarity"))


@register(
    "nearest_one",
    f"""{V('item_vectors', 'seeds')},
vn AS ({_vec_sql()}),
sc AS (SELECT s.movieId AS request_id, q.id AS query_id, c.id AS candidate_id,
              round({COS.format(a='q.vec', b='c.vec').replace('q.vecn', 'q.nrm').replace('c.vecn', 'c.nrm')}, 6) AS similarity
       FROM seeds s JOIN vn q ON s.movieId = q.id CROSS JOIN vn c WHERE c.id <> q.id),
rk AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, candidate_id) AS rn FROM sc)
SELECT request_id, query_id, candidate_id, similarity FROM rk WHERE rn = 1""",
)
def nearest_one(spark, sf_dir):
    """Arg-max neighbour of each requested item over all vectors."""
    iv = fx.item_vectors(spark, sf_dir)
    rq = fx.seed_requests(spark).select(F.col("movieId").alias("id")).withColumn("request_id", F.col("id"))
    return N.knn_scan(rq, iv, iv, k=1).drop("rank")


@register(
    "similar_users_all",
    f"""{V('user_vectors')},
tr AS (SELECT id, vec, sqrt(list_dot_product(vec, vec)) AS nrm FROM user_vectors WHERE {_USER_SPLIT} >= 2),
te AS (SELECT id, vec, sqrt(list_dot_product(vec, vec)) AS nrm FROM user_vectors WHERE {_USER_SPLIT} < 2),
sc AS (SELECT q.id AS request_id, q.id AS train_user_id, c.id AS test_user_id,
              round({COS.format(a='q.vec', b='c.vec').replace('q.vecn', 'q.nrm').replace('c.vecn', 'c.nrm')}, 6) AS similarity
       FROM tr q CROSS JOIN te c),
rk AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, test_user_id) AS rank FROM sc)
SELECT request_id, train_user_id, test_user_id, similarity,
       CASE WHEN similarity = 1.0 THEN 'identical' WHEN similarity > 0.99 THEN 'near identical'
            WHEN similarity > 0.95 THEN 'close' WHEN similarity > 0.90 THEN 'medium' ELSE 'weak' END AS similarity_level,
       CAST(rank AS INTEGER) AS rank
FROM rk WHERE rank <= 10""",
)
def similar_users_all(spark, sf_dir):
    """R12 as one batch: the 10 most similar test users of every train user, by pivot partitions."""
    uv = Fe.row_split(fx.user_vectors(spark, sf_dir), "id")
    tr, te = uv.where(F.col("split") == "train"), uv.where(F.col("split") == "test")
    return N.similar_users(tr.select("id", F.col("id").alias("request_id")), tr, te, 10, search=knn_pivots)


@register(
    "knn_pivots",
    f"""{V('item_vectors')},
v AS (SELECT id, vec, sqrt(list_dot_product(vec, vec)) AS nrm FROM item_vectors),
sc AS (SELECT q.id AS request_id, q.id AS query_id, c.id AS candidate_id,
              round({COS.format(a='q.vec', b='c.vec').replace('q.vecn', 'q.nrm').replace('c.vecn', 'c.nrm')}, 6) AS similarity
       FROM v q JOIN v c ON q.id <> c.id),
rk AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, candidate_id) AS rank FROM sc)
SELECT request_id, query_id, candidate_id, similarity, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 10""",
)
def knn_pivots_all(spark, sf_dir):
    """M11 for every item: its 10 nearest other items, by pivot partitions."""
    iv = fx.item_vectors(spark, sf_dir)
    return knn_pivots(iv.select("id", F.col("id").alias("request_id")), iv, iv, 10)


@register(
    "knn_pivot_pairs",
    f"""{V('item_vectors')}
SELECT count(*) AS requests, count(*) AS candidates, true AS no_more_than_the_grid FROM item_vectors""",
)
def knn_pivot_pairs(spark, sf_dir):
    """Pairs that ``knn_pivots`` scores, against those of the grid."""
    iv = fx.item_vectors(spark, sf_dir)
    pairs = PivotSearch(iv.select("id", F.col("id").alias("request_id")), iv, iv, 10).pairs()
    return pairs.select("requests", "candidates", (F.col("pairs_scored") <= F.col("requests") * F.col("candidates")).alias("no_more_than_the_grid"))
