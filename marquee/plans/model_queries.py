"""Registered clustering/model queries.

Quality measures on the given labels, nearest-centroid assignment, genre donors and
regression metrics of a deterministic baseline have DuckDB oracles. Model fits
(KMeans, PCA, ALS, FM, bridge, fold-in) have check queries whose invariants have oracles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import columns as C
from marquee.operators import clustering as Cl
from marquee.operators import features as Fe
from marquee.operators import models as M
from marquee.operators import neighbours as N
from marquee.operators import recommend as R
from marquee.operators import relational as Rel
from marquee.operators import users as U
from marquee.operators import vectors as Vec
from marquee.plans.catalog import register
from marquee.session import cut_lineage
from marquee.sources import fixtures as fx
from marquee.sources import io as sio

V = fx.with_views
_HASH = "('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8))::BIGINT % 10"

# long form + centroids of the given labels, and squared distances, in DuckDB
_CENT = """l AS (SELECT id, cluster, unnest(range(len(vec))) AS pos, unnest(vec) AS x FROM item_vectors),
cp AS (SELECT cluster, pos, avg(x) AS m FROM l GROUP BY cluster, pos),
cen AS (SELECT cluster, list(m ORDER BY pos) AS c FROM cp GROUP BY cluster),
sz AS (SELECT cluster, count(*) AS n FROM item_vectors GROUP BY cluster)"""
_SQ = "list_reduce(list_prepend(CAST(0 AS DOUBLE), list_transform(list_zip({a}, {b}), lambda t: (t[1] - t[2]) * (t[1] - t[2]))), lambda x, y: x + y)"


def _items(spark, sf_dir):
    return fx.item_vectors(spark, sf_dir)


def written_ratings(spark, sf_dir):
    """userId, movieId and rating, derived once for the several reads of a fit."""
    return sio.roundtrip_parquet(fx.ratings(spark, sf_dir).select("userId", "movieId", "rating"), "ratings")


# ------------------------------------------------------- quality (given labels)
@register(
    "assign_centroid",
    f"""{V('item_vectors')}, {_CENT},
d AS (SELECT v.id, c.cluster AS assigned, {_SQ.format(a='v.vec', b='c.c')} AS sq FROM item_vectors v CROSS JOIN cen c),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sq, assigned) AS rn FROM d) WHERE rn = 1)
SELECT id, assigned, round(sq, 6) AS sq_distance FROM b""",
)
def assign_centroid(spark, sf_dir):
    """Every vector to its nearest centroid (centroids: means of the given labels, broadcast)."""
    iv = _items(spark, sf_dir)
    out = Cl.assign_centroid(iv, Cl.centroids(iv))
    return out.select("id", "assigned", F.round("sq_distance", 6).alias("sq_distance"))


@register(
    "inertia",
    f"""{V('item_vectors')}, {_CENT}
SELECT round(sum({_SQ.format(a='v.vec', b='c.c')}), 6) AS inertia FROM item_vectors v JOIN cen c ON v.cluster = c.cluster""",
)
def inertia(spark, sf_dir):
    """A18."""
    return Cl.inertia(_items(spark, sf_dir))


@register(
    "davies_bouldin",
    f"""{V('item_vectors')}, {_CENT},
s AS (SELECT v.cluster, avg(sqrt({_SQ.format(a='v.vec', b='c.c')})) AS s FROM item_vectors v JOIN cen c ON v.cluster = c.cluster GROUP BY v.cluster),
cs AS (SELECT cen.cluster, cen.c, s.s FROM cen JOIN s ON cen.cluster = s.cluster),
r AS (SELECT a.cluster, max((a.s + b.s) / sqrt({_SQ.format(a='a.c', b='b.c')})) AS m FROM cs a JOIN cs b ON a.cluster <> b.cluster GROUP BY a.cluster)
SELECT round(avg(m), 6) AS davies_bouldin FROM r""",
)
def davies_bouldin(spark, sf_dir):
    """A19."""
    return Cl.davies_bouldin(_items(spark, sf_dir))


@register(
    "calinski_harabasz",
    f"""{V('item_vectors')}, {_CENT},
g AS (SELECT list(m ORDER BY pos) AS g FROM (SELECT pos, avg(x) AS m FROM l GROUP BY pos)),
w AS (SELECT sum({_SQ.format(a='v.vec', b='c.c')}) AS W, count(*) AS n FROM item_vectors v JOIN cen c ON v.cluster = c.cluster),
b AS (SELECT sum(sz.n * {_SQ.format(a='cen.c', b='g.g')}) AS B, count(*) AS k FROM cen JOIN sz ON cen.cluster = sz.cluster, g)
SELECT round((B / (k - 1)) / (W / (n - k)), 6) AS calinski_harabasz FROM w, b""",
)
def calinski_harabasz(spark, sf_dir):
    """A20."""
    return Cl.calinski_harabasz(_items(spark, sf_dir))


def _silhouette_sql(rows: str, cents: str) -> str:
    """Mean silhouette (squared Euclidean) of the rows (id, vec, cluster), given centroids (cluster, c, n)."""
    return f"""(SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN CAST(0 AS DOUBLE) ELSE (b - a) / greatest(a, b) END), 6)
  FROM (SELECT id, max(CASE WHEN own = c AND n > 1 THEN d * n / (n - 1) END) AS a, min(CASE WHEN own <> c THEN d END) AS b
    FROM (SELECT v.id, v.cluster AS own, c.cluster AS c, c.n, list_dot_product(v.vec, v.vec) - 2 * list_dot_product(v.vec, c.c) + q.s AS d
      FROM {rows} v CROSS JOIN {cents} c JOIN (SELECT cluster, avg(list_dot_product(vec, vec)) AS s FROM {rows} GROUP BY cluster) q ON q.cluster = c.cluster)
    GROUP BY id))"""


@register(
    "silhouette",
    f"""{V('item_vectors')}, {_CENT},
cn AS (SELECT cen.cluster, cen.c, sz.n FROM cen JOIN sz ON cen.cluster = sz.cluster)
SELECT {_silhouette_sql('item_vectors', 'cn')} AS silhouette""",
)
def silhouette(spark, sf_dir):
    """Mean silhouette of all rows, in one pass over them."""
    return Cl.silhouette(_items(spark, sf_dir))


@register(
    "silhouette_sample",
    f"""{V('item_vectors')},
smp AS (SELECT id, cluster, vec FROM item_vectors ORDER BY md5(CAST(id AS VARCHAR) || ':sample'), id LIMIT 2000),
d AS (SELECT a.id AS i, a.cluster AS li, b.cluster AS lj, sqrt({_SQ.format(a='a.vec', b='b.vec')}) AS d FROM smp a JOIN smp b ON a.id <> b.id),
per AS (SELECT i, li, lj, avg(d) AS md FROM d GROUP BY i, li, lj),
ab AS (SELECT i, max(CASE WHEN li = lj THEN md END) AS a, min(CASE WHEN li <> lj THEN md END) AS b FROM per GROUP BY i),
sc AS (SELECT CASE WHEN a IS NULL OR b IS NULL THEN CAST(0 AS DOUBLE) ELSE (b - a) / greatest(a, b) END AS s FROM ab)
SELECT round(sum(s) / (SELECT count(*) FROM smp), 6) AS silhouette FROM sc""",
)
def silhouette_sample(spark, sf_dir):
    """A21 as a sampling operator: exact Euclidean silhouette of 2 000 rows (the caller's size); ``silhouette``
    covers all rows."""
    return Cl.silhouette_sample(_items(spark, sf_dir), 2000)


def _folded_metrics(spark, sf_dir, ks=range(2, 11)):
    """Candidate segmentations: the given labels folded into k groups (label % k), all k scored in
    one job (rows replicated once per candidate k; every measure is grouped by k)."""
    iv = _items(spark, sf_dir)
    lab = iv.select("id", "vec", F.explode(F.sequence(F.lit(min(ks)), F.lit(max(ks)))).alias("k"), "cluster")
    lab = lab.withColumn("cluster", F.col("cluster") % F.col("k"))
    return Cl.quality_by_group(lab, ["k"]).select("k", "silhouette", "calinski_harabasz", "davies_bouldin", "inertia")


def _folded_sql() -> str:
    parts = []
    for k in range(2, 11):
        parts.append(f"""SELECT {k} AS k,
 {_silhouette_sql(f'fv{k}', f'fc{k}')} AS silhouette,
 (SELECT round((B / (kk - 1)) / (W / (n - kk)), 6) FROM
    (SELECT sum({_SQ.format(a='v.vec', b='c.c')}) AS W, count(*) AS n FROM fv{k} v JOIN fc{k} c ON v.cluster = c.cluster),
    (SELECT sum(c.n * {_SQ.format(a='c.c', b='g.g')}) AS B, count(*) AS kk FROM fc{k} c, g)) AS calinski_harabasz,
 (SELECT round(avg(m), 6) FROM (SELECT a.cluster, max((a.s + b.s) / sqrt({_SQ.format(a='a.c', b='b.c')})) AS m
    FROM fs{k} a JOIN fs{k} b ON a.cluster <> b.cluster GROUP BY a.cluster)) AS davies_bouldin,
 (SELECT round(sum({_SQ.format(a='v.vec', b='c.c')}), 6) FROM fv{k} v JOIN fc{k} c ON v.cluster = c.cluster) AS inertia""")
    ctes = []
    for k in range(2, 11):
        ctes.append(f"""fv{k} AS (SELECT id, vec, cluster % {k} AS cluster FROM item_vectors),
fl{k} AS (SELECT cluster, unnest(range(len(vec))) AS pos, unnest(vec) AS x FROM fv{k}),
fc{k} AS (SELECT c.cluster, c.c, n.n FROM (SELECT cluster, list(m ORDER BY pos) AS c FROM (SELECT cluster, pos, avg(x) AS m FROM fl{k} GROUP BY cluster, pos) GROUP BY cluster) c
          JOIN (SELECT cluster, count(*) AS n FROM fv{k} GROUP BY cluster) n ON c.cluster = n.cluster),
fs{k} AS (SELECT c.cluster, c.c, s.s FROM fc{k} c JOIN (SELECT v.cluster, avg(sqrt({_SQ.format(a='v.vec', b='c.c')})) AS s
          FROM fv{k} v JOIN fc{k} c ON v.cluster = c.cluster GROUP BY v.cluster) s ON c.cluster = s.cluster)""")
    return (f"""{V('item_vectors')},
g AS (SELECT list(m ORDER BY pos) AS g FROM (SELECT pos, avg(x) AS m FROM (SELECT unnest(range(len(vec))) AS pos, unnest(vec) AS x FROM item_vectors) GROUP BY pos)),
""" + ",\n".join(ctes) + ",\nmt AS (" + "\nUNION ALL\n".join(parts) + ")")


_RANK_SQL = """rk AS (SELECT *,
  (rank() OVER (ORDER BY silhouette DESC) + (count(*) OVER (PARTITION BY silhouette) - 1) / 2.0) AS r_sil,
  (rank() OVER (ORDER BY calinski_harabasz DESC) + (count(*) OVER (PARTITION BY calinski_harabasz) - 1) / 2.0) AS r_ch,
  (rank() OVER (ORDER BY davies_bouldin) + (count(*) OVER (PARTITION BY davies_bouldin) - 1) / 2.0) AS r_db,
  (rank() OVER (ORDER BY inertia) + (count(*) OVER (PARTITION BY inertia) - 1) / 2.0) AS r_in FROM mt)"""


@register(
    "k_rank_vote",
    _folded_sql() + ",\n" + _RANK_SQL + """
SELECT k, silhouette, calinski_harabasz, davies_bouldin, inertia,
  CAST(r_sil AS DOUBLE) AS r_sil, CAST(r_ch AS DOUBLE) AS r_ch, CAST(r_db AS DOUBLE) AS r_db, CAST(r_in AS DOUBLE) AS r_in,
  CAST(r_sil + r_ch + r_db + r_in AS DOUBLE) AS rank_total FROM rk""",
)
def k_rank_vote(spark, sf_dir):
    """Average ranks per quality measure over candidate k, and their total."""
    out = Cl.k_rank_vote(_folded_metrics(spark, sf_dir))
    return out.select("k", "silhouette", "calinski_harabasz", "davies_bouldin", "inertia",
                      *[F.col(c).cast("double").alias(c) for c in ("r_sil", "r_ch", "r_db", "r_in", "rank_total")])


@register(
    "best_k",
    _folded_sql() + "\nSELECT k, silhouette FROM mt ORDER BY silhouette DESC, k LIMIT 1",
)
def best_k(spark, sf_dir):
    """K with the highest silhouette."""
    return Cl.best_k(_folded_metrics(spark, sf_dir), "silhouette", True)


# ---------------------------------------------------------------- baselines
_PRED_SQL = """pop AS (SELECT movieId, avg(rating) AS prediction FROM ratings GROUP BY movieId),
pr AS (SELECT r.rating, p.prediction FROM ratings r JOIN pop p ON r.movieId = p.movieId),
mu AS (SELECT avg(rating) AS mu FROM pr)"""


@register(
    "regression_metrics",
    f"""{V('ratings')}, {_PRED_SQL}
SELECT round(sqrt(sum((rating - prediction) * (rating - prediction)) / count(*)), 6) AS rmse,
       round(sum((rating - prediction) * (rating - prediction)) / count(*), 6) AS mse,
       round(avg(abs(rating - prediction)), 6) AS mae,
       round(1 - sum((rating - prediction) * (rating - prediction)) / sum((rating - mu) * (rating - mu)), 6) AS r2
FROM pr, mu""",
)
def regression_metrics(spark, sf_dir):
    """A15 on the item-mean baseline predictor (the bar every rating model must beat)."""
    r = fx.ratings(spark, sf_dir)
    pred = r.join(Rel.popularity(r, mean_name="prediction"), "movieId")
    return M.regression_metrics(pred)


@register(
    "metrics_json_roundtrip",
    f"""{V('ratings')}, {_PRED_SQL}
SELECT round(sqrt(sum((rating - prediction) * (rating - prediction)) / count(*)), 6) AS rmse,
       round(sum((rating - prediction) * (rating - prediction)) / count(*), 6) AS mse,
       round(avg(abs(rating - prediction)), 6) AS mae,
       round(1 - sum((rating - prediction) * (rating - prediction)) / sum((rating - mu) * (rating - mu)), 6) AS r2
FROM pr, mu""",
)
def metrics_json_roundtrip(spark, sf_dir):
    """A metric table written as JSON to the shared folder and read back with its schema."""
    m = regression_metrics(spark, sf_dir)
    path = sio.write_metrics_json(m, "metrics")
    return spark.read.schema(m.schema).json(path)


@register(
    "masked_mse",
    f"""{V('ratings')},
im AS (SELECT userId, movieId, sum(rating) AS value FROM ratings GROUP BY userId, movieId),
rc AS (SELECT movieId, avg(value) AS reconstruction FROM im GROUP BY movieId)
SELECT round(avg((im.value - rc.reconstruction) * (im.value - rc.reconstruction)), 6) AS masked_mse
FROM im JOIN rc ON im.movieId = rc.movieId WHERE im.value <> 0""",
)
def masked_mse(spark, sf_dir):
    """Error on observed cells only (reconstruction = item mean of the summed matrix)."""
    im = Rel.interaction_matrix(fx.ratings(spark, sf_dir)).withColumnRenamed("rating", "value")
    rc = im.groupBy("movieId").agg(F.avg("value").alias("reconstruction"))
    return M.masked_mse(im, rc, ["movieId"])


@register(
    "closest_by_genres",
    f"""{V('movies', 'item_vectors')},
rq AS (SELECT movieId AS request_id, list_distinct(string_split(genres, '|')) AS g FROM movies WHERE movieId NOT IN (SELECT id FROM item_vectors)),
dn AS (SELECT movieId, list_distinct(string_split(genres, '|')) AS g FROM movies WHERE movieId IN (SELECT id FROM item_vectors)),
ov AS (SELECT rq.request_id, dn.movieId, len(list_intersect(rq.g, dn.g)) AS overlap FROM rq CROSS JOIN dn),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY overlap DESC, movieId) AS rn FROM ov WHERE overlap >= 1) WHERE rn = 1)
SELECT rq.request_id, b.movieId AS donor_id, CAST(coalesce(b.overlap, 0) AS INTEGER) AS overlap FROM rq LEFT JOIN b ON b.request_id = rq.request_id""",
)
def closest_by_genres(spark, sf_dir):
    """Every catalogue item without a content vector gets the vector-bearing item that shares
    the most genres (ties: smallest id) - the donor used to place new items."""
    mv = fx.movies(spark, sf_dir)
    iv = _items(spark, sf_dir)
    req = mv.join(iv.select(F.col("id").alias("movieId")), "movieId", "left_anti").select(
        F.col("movieId").alias("request_id"), C.genre_tokens("genres").alias("genres"))
    return M.closest_by_genres(req, mv, iv)


# --------------------------------------------------------------- model fits
# Sizes of the reference's parameter file.
ITEM_CLUSTERS, SWEEP, FACTORS, ITERATIONS, REG = 150, range(2, 21), 64, 15, 0.1


@register("kmeans_items")
def kmeans_items(spark, sf_dir):
    """M5: KMeans(k=150, seed=42) on item content vectors -> (id, cluster)."""
    _, assigned = Cl.kmeans_fit(_items(spark, sf_dir), ITEM_CLUSTERS, 42)
    return assigned


@register("kmeans_users")
def kmeans_users(spark, sf_dir):
    """M5: KMeans(k=150, seed=42) on user vectors."""
    _, assigned = Cl.kmeans_fit(fx.user_vectors(spark, sf_dir), ITEM_CLUSTERS, 42)
    return assigned


@register(
    "kmeans_check",
    f"""{V('item_vectors', 'user_vectors')}
SELECT 'items' AS side, count(*) AS n_rows, count(DISTINCT id) AS n_ids, 0::BIGINT AS out_of_range FROM item_vectors
UNION ALL SELECT 'users', count(*), count(DISTINCT id), 0::BIGINT FROM user_vectors""",
)
def kmeans_check(spark, sf_dir):
    """M5 invariants: every id once, labels within k."""
    parts = []
    for side, fit in (("items", kmeans_items), ("users", kmeans_users)):
        parts.append(fit(spark, sf_dir).agg(
            F.lit(side).alias("side"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"),
            F.sum((~F.col("cluster").between(0, ITEM_CLUSTERS - 1)).cast("bigint")).alias("out_of_range")))
    return parts[0].unionByName(parts[1])


@register("k_sweep")
def k_sweep(spark, sf_dir):
    """KMeans for k = 2..20 with silhouette / CH / DB / inertia per k, over all rows."""
    return Cl.k_sweep(_items(spark, sf_dir).select("id", "vec"), SWEEP)


@register("segments_by_vote")
def segments_by_vote(spark, sf_dir):
    """M3 -> M5c -> W1 -> final assignment: item segments of the k that the four measures vote for."""
    feats = Fe.segment_features(fx.movies(spark, sf_dir), fx.ratings(spark, sf_dir))
    return Cl.segment_by_vote(feats.select(F.col("movieId").alias("id"), F.col("features").alias("vec")), SWEEP)


@register(
    "segments_check",
    f"""{V('movies', 'ratings')}
SELECT (SELECT count(*) FROM movies) AS n_rows, 0::BIGINT AS out_of_range,
       (SELECT count(DISTINCT userId) FROM ratings WHERE rating > 3.5) AS n_users""",
)
def segments_check(spark, sf_dir):
    """The fitted segments feed the watched-segment lists (R10): every movie is placed once, and every user with
    a positive rating gets a list."""
    seg = segments_by_vote(spark, sf_dir).select(F.col("id").alias("movieId"), "cluster")
    placed = seg.agg(F.count(F.lit(1)).alias("n_rows"), F.sum((~F.col("cluster").between(0, max(SWEEP) - 1)).cast("bigint")).alias("out_of_range"))
    req = fx.positive_ratings(spark, sf_dir, 3.5).select(F.col("userId").alias("request_id"), "movieId")
    lists = U.watched_segments(req, seg, fx.movies(spark, sf_dir), fx.ratings(spark, sf_dir), 10)
    return placed.crossJoin(lists.agg(F.countDistinct("request_id").alias("n_users")))


@register(
    "model_roundtrip",
    f"{V('item_vectors')} SELECT count(*) AS n_rows, 0::BIGINT AS mismatches FROM item_vectors",
)
def model_roundtrip(spark, sf_dir):
    """A fitted KMeans model saved to the shared folder, loaded and applied: the same labels."""
    from pyspark.ml.clustering import KMeansModel
    from pyspark.ml.functions import array_to_vector

    iv = _items(spark, sf_dir)
    model, before = Cl.kmeans_fit(iv, ITEM_CLUSTERS, 42)
    loaded = KMeansModel.load(sio.save_model(model, "kmeans", spark))
    after = loaded.transform(iv.select("id", array_to_vector("vec").alias("features"))).select("id", F.col("cluster").alias("again"))
    both = before.join(after, "id")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.sum((F.col("cluster") != F.col("again")).cast("bigint")).alias("mismatches"))


def _content_raw(spark, sf_dir):
    tags = fx.genome_tags(spark, sf_dir)
    cm = Fe.content_matrix(fx.genome_scores(spark, sf_dir), tags, None, False)
    return sio.long_to_dense(cm, "movieId", "tagId", "value", "vec", columns=tags).withColumnRenamed("movieId", "id")


@register("encode_items")
def encode_items(spark, sf_dir):
    """M6 (re-aimed): PCA(k=64) of the min-max scaled tag vectors -> item encodings."""
    x = _content_raw(spark, sf_dir)
    return M.pca_encode(M.pca_fit(x, FACTORS), x)


_SCALED_SQL = """st AS (SELECT tagId, min(relevance) AS mn, max(relevance) AS mx FROM genome_scores GROUP BY tagId),
sc AS (SELECT s.movieId, s.tagId, round((s.relevance - st.mn) / CASE WHEN st.mx = st.mn THEN 1 ELSE st.mx - st.mn END, 6) AS v FROM genome_scores s JOIN st USING (tagId)),
mu AS (SELECT tagId, avg(v) AS m FROM sc GROUP BY tagId)"""


@register(
    "encode_items_check",
    f"""{V('genome_scores')}, {_SCALED_SQL}
SELECT movieId AS id, round(sum((v - m) * (v - m)), 4) AS sq_norm FROM sc JOIN mu USING (tagId) GROUP BY movieId""",
)
def encode_items_check(spark, sf_dir):
    """M6 invariant: with as many axes as dimensions, an encoding is as far from 0 as its row from the mean."""
    e = encode_items(spark, sf_dir)
    return e.select("id", F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x), 4).alias("sq_norm"))


@register(
    "reconstruction_mse",
    f"""{V('genome_scores')}, {_SCALED_SQL}
SELECT round(avg((v - m) * (v - m)), 6) AS total_variance, CAST(0 AS DOUBLE) AS full_rank_mse, true AS below_variance
FROM sc JOIN mu USING (tagId)""",
)
def reconstruction_mse(spark, sf_dir):
    """M6: reconstruction error per cell with 64 axes (all dimensions here: none), and with 16 axes below the variance."""
    x = _content_raw(spark, sf_dir)
    full = M.pca_errors(M.pca_fit(x, FACTORS), x).agg(
        F.round(F.sum("spread") / F.sum("d"), 6).alias("total_variance"), F.abs(F.round(F.sum("error") / F.sum("d"), 6)).alias("full_rank_mse"))
    part = M.pca_reconstruction_mse(M.pca_fit(x, 16), x)
    return full.crossJoin(part).select(
        "total_variance", "full_rank_mse", (F.col("reconstruction_mse") < F.col("total_variance")).alias("below_variance"))


@register(
    "sparse_matrix_dense",
    f"""{V('genome_scores')}, q AS (SELECT quantile_cont(relevance, 0.75) AS t FROM genome_scores),
kept AS (SELECT movieId, tagId, relevance FROM genome_scores, q WHERE relevance >= t),
grid AS (SELECT m.movieId, t.tagId FROM (SELECT DISTINCT movieId FROM kept) m CROSS JOIN (SELECT DISTINCT tagId FROM genome_scores) t)
SELECT g.movieId, list(coalesce(k.relevance, CAST(0 AS DOUBLE)) ORDER BY g.tagId) AS vec
FROM grid g LEFT JOIN kept k ON k.movieId = g.movieId AND k.tagId = g.tagId GROUP BY g.movieId""",
)
def sparse_matrix_dense(spark, sf_dir):
    """S7 on sparse input: the upper quarter of the scores as 0-filled rows over the whole tag dictionary."""
    gs = fx.genome_scores(spark, sf_dir)
    kept = Rel.with_scalars(gs, Rel.scalar_quantile(gs, "relevance", 0.75, "_t")).where(F.col("relevance") >= F.col("_t"))
    return sio.long_to_dense(kept, "movieId", "tagId", "relevance", "vec", columns=fx.genome_tags(spark, sf_dir))


@register("encode_user_segments")
def encode_user_segments(spark, sf_dir):
    """M7b (re-aimed): PCA of the standardized user segment matrix with 64 axes, or its full width."""
    usm = Fe.user_segment_matrix(fx.ratings(spark, sf_dir), fx.movies(spark, sf_dir), fx.item_clusters(spark, sf_dir))
    x = usm.select(F.col("userId").alias("id"), F.concat("genre_share", "cluster_rating",
                                                          F.array(F.col("positive_count").cast("double"))).alias("vec"))
    x = cut_lineage(x)  # each step of the scaling and of the PCA reads the rows again
    x = cut_lineage(Vec.standard_scale(x, "vec", "scaled").select("id", F.col("scaled").alias("vec")))
    width = x.agg(F.max(F.size("vec"))).first()[0]
    return M.pca_encode(M.pca_fit(x, min(FACTORS, width)), x)


@register("encode_users")
def encode_users(spark, sf_dir):
    """M7 (re-aimed): explicit ALS user factors (64) as user encodings."""
    return M.factors(M.als_fit(written_ratings(spark, sf_dir), FACTORS, REG, ITERATIONS), "user")


@register("als_item_factors")
def als_item_factors(spark, sf_dir):
    """M8: implicit ALS, 64 factors, reg 0.1, 15 iterations, alpha 1 -> item factors."""
    return M.factors(M.als_fit(written_ratings(spark, sf_dir), FACTORS, REG, ITERATIONS, implicit=True), "item")


@register(
    "factors_check",
    f"""{V('ratings')}
SELECT 'users' AS side, count(DISTINCT userId) AS n_rows, count(DISTINCT userId) AS n_ids, 64 AS width FROM ratings
UNION ALL SELECT 'items', count(DISTINCT movieId), count(DISTINCT movieId), 64 FROM ratings""",
)
def factors_check(spark, sf_dir):
    """M7 / M8 invariants: one vector of 64 factors for every rating user and rated item."""
    parts = [f(spark, sf_dir).agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"),
                                  F.max(F.size("vec")).alias("width")) for side, f in (("users", encode_users), ("items", als_item_factors))]
    return parts[0].unionByName(parts[1])


def _encoder(spark, sf_dir):
    """Content space of the items: min-max scaling and PCA axes fitted on them, and both applied (M1, M6)."""
    iv = _items(spark, sf_dir)
    stats = Vec.dim_stats(iv)

    def scaled(df):
        return Vec.minmax_scale(df, "vec", "scaled", stats).drop("vec").withColumnRenamed("scaled", "vec")

    pca = M.pca_fit(scaled(iv), FACTORS)

    def encode(df):
        keep = [c for c in df.columns if c not in ("id", "vec")]
        return M.pca_encode(pca, scaled(df)).join(df.select("id", *keep), "id") if keep else M.pca_encode(pca, scaled(df))

    return iv, encode


def _bridge(spark, sf_dir):
    """Encodings of the items, their ALS factors, and the least-squares bridge between them (M9)."""
    iv, encode = _encoder(spark, sf_dir)
    enc = sio.roundtrip_parquet(encode(iv.select("id", "vec")), "encodings")
    f = sio.roundtrip_parquet(als_item_factors(spark, sf_dir), "factors")
    return iv, encode, enc, f, M.bridge_fit(enc, f)


@register("bridge_scores")
def bridge_scores(spark, sf_dir):
    """M9 (re-aimed): one least-squares bridge content -> ALS factors; r2 / MAE / std per factor."""
    _, _, enc, f, beta = _bridge(spark, sf_dir)
    return M.bridge_scores(enc, f, beta)


@register("weak_dims")
def weak_dims(spark, sf_dir):
    """Mean bridge scores and the factors with r2 < 0.1."""
    _, _, enc, f, beta = _bridge(spark, sf_dir)
    return M.weak_dims(M.bridge_scores(enc, f, beta))


@register(
    "bridge_check",
    "SELECT 64::BIGINT AS n_factors, 0::BIGINT AS worse_than_mean, true AS weak_listed, true AS normal_equations",
)
def bridge_check(spark, sf_dir):
    """M9 / A17 invariants: a score for each factor, none worse than the mean (least squares with an intercept), the
    weak list is that of r2 < 0.1, and residuals are orthogonal to every content dimension."""
    _, _, enc, f, beta = _bridge(spark, sf_dir)
    scores = sio.roundtrip_parquet(M.bridge_scores(enc, f, beta), "bridge-scores")
    one = scores.agg(F.count(F.lit(1)).alias("n_factors"), F.sum((F.col("r2") < -1e-6).cast("bigint")).alias("worse_than_mean"),
                     F.sort_array(F.collect_list(F.when(F.col("r2") < 0.1, F.col("factor")))).alias("_weak"))
    rest = M.bridge_predict(enc, beta).join(f.select("id", F.col("vec").alias("y")), "id").select(
        F.posexplode("vec").alias("i", "x"), F.zip_with("y", "pred", lambda a, b: a - b).alias("rest"))
    off = rest.select("i", "x", F.posexplode("rest").alias("j", "e")).groupBy("i", "j").agg(F.abs(F.sum(F.col("x") * F.col("e"))).alias("off"))
    both = one.crossJoin(M.weak_dims(scores)).crossJoin(off.agg((F.max("off") < 1e-3).alias("normal_equations")))
    return both.select("n_factors", "worse_than_mean", (F.col("_weak") == F.col("weak_factors")).alias("weak_listed"), "normal_equations")


def _split_ratings(spark, sf_dir):
    r = fx.ratings(spark, sf_dir)
    b = C.hash_bucket(F.concat_ws(":", F.col("userId").cast("string"), F.col("movieId").cast("string")))
    r = cut_lineage(r.select("userId", "movieId", "rating", (b >= 1).alias("_train")))
    return r.where("_train").drop("_train"), r.where(~F.col("_train")).drop("_train")


def _centred(df, mean: float):
    return df.withColumn("rating", F.col("rating") - F.lit(mean))


def _rmse(pred, mean: float) -> float:
    """Of predictions of centred ratings; what a model can't predict is the mean."""
    e = F.col("rating") - F.coalesce(F.when(~F.isnan("prediction"), F.col("prediction")), F.lit(0.0))
    return pred.agg(F.sqrt(F.avg(e * e))).first()[0] or 0.0


def _validated(train, fit, grid):
    """The model of the strongest regularisation that does best on a tenth of the training rows, refitted on all."""
    b = C.hash_bucket(F.concat_ws(":", F.lit("v"), F.col("userId").cast("string"), F.col("movieId").cast("string")))
    train = cut_lineage(train.withColumn("_inner", b >= 1))
    inner, valid = train.where("_inner"), train.where(~F.col("_inner"))
    scored = [(_rmse(fit(inner, reg)(valid), 0.0), -reg, reg) for reg in grid]
    return fit(train, min(scored)[2])


def _als_predictor():
    """Fits that follow on the same rows share them coded and dealt."""
    last = {}

    def fit(train, reg):
        if last.get("rows") is not train:
            if last:
                last["coded"].dealt.discard()
            last.update(rows=train, coded=M.als_ratings(train))
        model = M.als_fit(last["coded"], FACTORS, reg, ITERATIONS)
        return lambda df: model.predict(df.select("userId", "movieId", "rating"))

    return fit


def _fm_predictor(train, reg):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import FMRegressor

    def feats(df):
        return df.select("rating", array_to_vector("features").alias("features"))

    model = FMRegressor(factorSize=8, maxIter=50, stepSize=0.01, regParam=reg, seed=42, labelCol="rating").fit(feats(train))
    return lambda df: model.transform(feats(df))


def _rating_report(spark, sf_dir, fit, grid, with_features: bool):
    """Test metrics of a model of the ratings' distance from the training mean. The ratings are derived once, and the
    training rows are written with their features, not made anew by every fit and score."""
    train, test = _split_ratings(spark, sf_dir)
    mean = train.agg(F.avg("rating")).first()[0]
    if with_features:
        uv = fx.user_vectors(spark, sf_dir).select(F.col("id").alias("userId"), F.col("vec").alias("u"))
        iv = _items(spark, sf_dir).select(F.col("id").alias("movieId"), F.col("vec").alias("i"))
        train, test = (df.join(uv, "userId").join(iv, "movieId").withColumn("features", F.concat("u", "i")) for df in (train, test))
    pred = _validated(_centred(train, mean), fit, grid)(_centred(test, mean))
    pred = pred.select((F.col("rating") + mean).alias("rating"),
                       (F.coalesce(F.when(~F.isnan("prediction"), F.col("prediction")), F.lit(0.0)) + mean).cast("double").alias("prediction"))
    pred = sio.roundtrip_parquet(pred, "predictions")
    base = pred.agg(F.round(F.sqrt(F.avg((F.col("rating") - mean) ** 2)), 6).alias("mean_rmse"))
    return M.regression_metrics(pred).crossJoin(base)


@register("rating_als")
def rating_als(spark, sf_dir):
    """M10b (re-aimed): explicit ALS (64 factors) on ratings centred on the training mean, regularised by a
    validation split; test RMSE / MAE / r2 beside the RMSE of the training mean on the same rows."""
    return _rating_report(spark, sf_dir, _als_predictor(), (1.0, 3.0), False)


@register("rating_regressor")
def rating_regressor(spark, sf_dir):
    """M10 (re-aimed): FM regressor on [user vector || item vector], centred and regularised likewise."""
    return _rating_report(spark, sf_dir, _fm_predictor, (0.1, 10.0), True)


@register("rating_check", "SELECT 'als' AS model, true AS no_worse_than_mean UNION ALL SELECT 'fm', true")
def rating_check(spark, sf_dir):
    """M10 / M10b invariant: neither model does worse on the test rows than the training mean (by over 1 %; these
    ratings are close to random)."""
    parts = [f(spark, sf_dir).select(F.lit(n).alias("model"), (F.col("rmse") <= 1.01 * F.col("mean_rmse")).alias("no_worse_than_mean"))
             for n, f in (("als", rating_als), ("fm", rating_regressor))]
    return parts[0].unionByName(parts[1])


@register("predicted_topk")
def predicted_topk(spark, sf_dir):
    """Top 50 items by predicted rating with title and genres, for every user (ALS recommendForAllUsers)."""
    model = M.als_fit(written_ratings(spark, sf_dir), FACTORS, REG, ITERATIONS)
    x = model.recommend_all(50)
    return x.join(fx.movies(spark, sf_dir).select("movieId", "title", "genres"), "movieId")


@register(
    "predicted_topk_check",
    f"""{V('ratings')}, n AS (SELECT least(50, count(DISTINCT movieId)) AS n FROM ratings)
SELECT count(DISTINCT userId) AS n_users, count(DISTINCT userId) * any_value(n) AS n_rows, 0::BIGINT AS gaps FROM ratings, n""",
)
def predicted_topk_check(spark, sf_dir):
    """R9 invariants: a full list for every user, ranks without gaps, ratings not rising."""
    x = predicted_topk(spark, sf_dir)
    per = x.groupBy("userId").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("top"),
                                  F.sort_array(F.collect_list(F.struct("rank", "predicted_rating"))).alias("l"))
    falls = F.exists(F.sequence(F.lit(1), F.size("l") - 1), lambda i: F.get("l", i)["predicted_rating"] > F.get("l", i - 1)["predicted_rating"])
    return per.agg(F.count(F.lit(1)).alias("n_users"), F.sum("n").alias("n_rows"),
                   F.sum(((F.col("n") != F.col("top")) | falls).cast("bigint")).alias("gaps"))


def _new_users(spark, r):
    """New users: the rating histories of users 1, 10, 100 in ``r`` re-keyed as fresh ids max + 1, ..."""
    seeds = fx.seed_requests(spark).select(F.col("movieId").alias("userId"))
    base = Rel.next_id(r, "userId", "_base")
    new = seeds.crossJoin(base).select("userId", (F.col("_base") + F.col("userId")).alias("new_id"))
    return r.join(new, "userId").select(F.col("new_id").alias("userId"), "movieId", "rating")


@register("fold_in_users")
def fold_in_users(spark, sf_dir):
    """Vectors for new users from their ratings against fixed ALS item factors."""
    r = written_ratings(spark, sf_dir)
    f = M.factors(M.als_fit(r, FACTORS, REG, ITERATIONS), "item")
    return M.fold_in_users(_new_users(spark, r), f, REG)


@register(
    "fold_in_check",
    f"""{V('ratings', 'seeds')}
SELECT count(DISTINCT userId) AS n_users, true AS like_the_fit FROM ratings WHERE userId IN (SELECT movieId FROM seeds)""",
)
def fold_in_check(spark, sf_dir):
    """M13 invariant: a new user with the ratings of a known one gets that user's fitted vector (ALS solves users last
    or first by the same equations, so the two agree closely)."""
    r = written_ratings(spark, sf_dir)
    model = M.als_fit(r, FACTORS, REG, ITERATIONS)
    new = M.fold_in_users(_new_users(spark, r), M.factors(model, "item"), REG)
    base = Rel.next_id(r, "userId", "_base")
    known = Rel.with_scalars(M.factors(model, "user"), base).select((F.col("_base") + F.col("id")).alias("id"), F.col("vec").alias("old"))
    j = new.join(known, "id").select(C.cosine("vec", "old").alias("c"))
    return j.agg(F.count(F.lit(1)).alias("n_users"), (F.min("c") > 0.9).alias("like_the_fit"))


@register("new_user_recs")
def new_user_recs(spark, sf_dir):
    """New users -> fold-in -> nearest segment centroid -> banded peers -> co-rating ensemble."""
    r = written_ratings(spark, sf_dir)
    model = M.als_fit(r, FACTORS, REG, ITERATIONS)
    users = M.factors(model, "user").join(fx.user_clusters(spark, sf_dir).select(F.col("user_id").alias("id"), "cluster"), "id")
    new = M.fold_in_users(_new_users(spark, r), M.factors(model, "item"), REG)
    placed = Cl.assign_centroid(new, Cl.centroids(users)).select("id", F.col("assigned").alias("cluster"))
    new_v = new.join(placed, "id")
    space = users.unionByName(new_v.select("id", "vec", "cluster"))
    req = new_v.select(F.col("id").alias("request_id"), F.col("id").alias("user_id"))
    all_r = r.select("userId", "movieId", "rating").unionByName(_new_users(spark, r))
    return U.user_ensemble(req, space, all_r, fx.movies(spark, sf_dir))


def _placed_items(spark, sf_dir):
    """Items without a content vector: genre donor (W7) -> donor vector, scaled and encoded (M1, M6) ->
    bridge-predicted factors (M9) -> hybrid vector -> nearest hybrid centroid; (id, donor_id, cluster, vec) of
    old items (encoding || their own ALS factors) and new ones."""
    mv = fx.movies(spark, sf_dir)
    iv, encode, enc, f, beta = _bridge(spark, sf_dir)
    req = mv.join(iv.select(F.col("id").alias("movieId")), "movieId", "left_anti").select(
        F.col("movieId").alias("request_id"), C.genre_tokens("genres").alias("genres"))
    donors = M.closest_by_genres(req, mv, iv).where(F.col("donor_id").isNotNull())
    new_vec = donors.join(iv.select(F.col("id").alias("donor_id"), "vec"), "donor_id").select(
        F.col("request_id").alias("id"), "donor_id", "vec")
    hyb_new = M.bridge_predict(encode(new_vec), beta).select("id", "donor_id", F.concat("vec", "pred").alias("vec"))
    own = f.select("id", F.col("vec").alias("own"))
    hyb_old = M.bridge_predict(enc, beta).join(own, "id", "left").join(iv.select("id", "cluster"), "id").select(
        "id", "cluster", F.concat("vec", F.coalesce("own", "pred")).alias("vec"))
    hyb_old = sio.roundtrip_parquet(hyb_old, "hybrid")
    placed = Cl.assign_centroid(hyb_new, Cl.centroids(hyb_old)).select("id", F.col("assigned").alias("cluster"))
    new = hyb_new.join(placed, "id").select("id", "donor_id", "cluster", "vec")
    return new.unionByName(hyb_old.select("id", F.lit(None).cast("bigint").alias("donor_id"), "cluster", "vec"))


@register("add_items")
def add_items(spark, sf_dir):
    """The keyed item set with the new items placed in it."""
    return _placed_items(spark, sf_dir).select("id", "donor_id", "cluster")


@register(
    "add_items_check",
    f"""{V('movies', 'item_vectors')},
v AS (SELECT id FROM item_vectors WHERE id IN (SELECT movieId FROM movies) OR TRUE),
dn AS (SELECT string_split(genres, '|') AS g FROM movies WHERE movieId IN (SELECT id FROM item_vectors)),
t AS (SELECT DISTINCT unnest(g) AS t FROM dn),
nw AS (SELECT movieId FROM movies WHERE movieId NOT IN (SELECT id FROM item_vectors) AND list_has_any(string_split(genres, '|'), (SELECT list(t) FROM t)))
SELECT (SELECT count(*) FROM v) AS n_old, (SELECT count(*) FROM nw) AS n_new, 0::BIGINT AS repeated, 0::BIGINT AS unknown_clusters""",
)
def add_items_check(spark, sf_dir):
    """M14 invariants: every old item, every new item with a donor, once each, in known clusters."""
    x = add_items(spark, sf_dir)
    known = _items(spark, sf_dir).select("cluster").distinct()
    bad = x.join(known, "cluster", "left_anti").agg(F.count(F.lit(1)).alias("unknown_clusters"))
    return x.agg(F.sum(F.col("donor_id").isNull().cast("bigint")).alias("n_old"), F.sum(F.col("donor_id").isNotNull().cast("bigint")).alias("n_new"),
                 (F.count(F.lit(1)) - F.countDistinct("id")).alias("repeated")).crossJoin(bad)


@register("new_item_recs")
def new_item_recs(spark, sf_dir):
    """Recommendations for newly placed items: cluster mates by cosine of the hybrid vectors, no genre gate,
    seeds excluded."""
    placed = sio.roundtrip_parquet(_placed_items(spark, sf_dir), "placed")
    req = placed.where(F.col("donor_id").isNotNull()).select(F.col("id").alias("request_id"), F.col("id").alias("movieId"))
    return N.content_neighbours(req, placed.select("id", "vec", "cluster"), fx.movies(spark, sf_dir), top_n=50, gate=False, exclude_seeds=True)


@register("hybrid_neighbours_als")
def hybrid_neighbours_als(spark, sf_dir):
    """R5 on hybrid vectors of content encodings and ALS item factors; seeds and blocked ids excluded."""
    hybrid = _placed_items(spark, sf_dir).where(F.col("donor_id").isNull()).select("id", "vec", "cluster")
    return N.content_neighbours(fx.seed_requests(spark), hybrid, fx.movies(spark, sf_dir), exclude_seeds=True,
                                blocked=R.blocked_ids(fx.importance(spark, sf_dir)))


@register(
    "hybrid_als_check",
    f"""{V('item_vectors', 'movies', 'seeds', 'importance')},
last AS (SELECT movieId, arg_max(importance_score, seq) AS s FROM importance GROUP BY movieId),
cand AS (SELECT v.id FROM item_vectors v JOIN movies m ON m.movieId = v.id WHERE v.id NOT IN (SELECT movieId FROM seeds)
         AND v.id NOT IN (SELECT movieId FROM last WHERE s = -1) AND v.cluster IN (SELECT cluster FROM item_vectors WHERE id IN (SELECT movieId FROM seeds)))
SELECT least(50, count(*)) AS n_rows, 0::BIGINT AS outside FROM cand""",
)
def hybrid_als_check(spark, sf_dir):
    """R5 invariants: a full list, of allowed items in the seeds' clusters only."""
    iv = _items(spark, sf_dir)
    seeds = fx.seed_requests(spark).select(F.col("movieId").alias("id"))
    fit = iv.join(iv.join(seeds, "id").select("cluster").distinct(), "cluster").select("id").join(seeds, "id", "left_anti").join(
        R.blocked_ids(fx.importance(spark, sf_dir)).select(F.col("movieId").alias("id")), "id", "left_anti")
    got = sio.roundtrip_parquet(hybrid_neighbours_als(spark, sf_dir), "hybrid-list").select(F.col("movie_id").alias("id"))
    return got.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(got.join(fit, "id", "left_anti").agg(F.count(F.lit(1)).alias("outside")))


@register("knn_lsh")
def knn_lsh(spark, sf_dir):
    """M11 at scale: approximate cosine neighbours (similarity >= 0.3) via random-projection LSH."""
    iv = _items(spark, sf_dir).select("id", "vec")
    return N.knn_lsh(iv, iv, 0.3)
