"""Registered feature-matrix queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import features as Fe
from marquee.operators import vectors as Vec
from marquee.plans.catalog import register
from marquee.sources import fixtures as fx

V = fx.with_views
_HASH = "('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8))::BIGINT % 10"
_ZERO = "CAST(0 AS DOUBLE)"
_ONE = "CAST(1 AS DOUBLE)"


@register(
    "user_segment_matrix",
    f"""{V('ratings', 'movies', 'item_clusters')},
pos AS (SELECT userId, movieId, rating FROM ratings WHERE rating > 3.5),
gc AS (SELECT p.userId, g.genre, count(*) AS n FROM pos p
       JOIN (SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM movies) g ON p.movieId = g.movieId
       GROUP BY p.userId, g.genre),
gs AS (SELECT userId, genre, n / sum(n) OVER (PARTITION BY userId) AS share FROM gc),
gv AS (SELECT DISTINCT genre FROM gc), gu AS (SELECT DISTINCT userId FROM gc),
ga AS (SELECT u.userId, list(coalesce(gs.share, {_ZERO}) ORDER BY v.genre) AS genre_share
       FROM gu u CROSS JOIN gv v LEFT JOIN gs ON gs.userId = u.userId AND gs.genre = v.genre GROUP BY u.userId),
cm AS (SELECT p.userId, c.cluster, avg(p.rating) AS r FROM pos p JOIN item_clusters c ON p.movieId = c.movieId GROUP BY 1, 2),
cv AS (SELECT DISTINCT cluster FROM cm), cu AS (SELECT DISTINCT userId FROM cm),
ca AS (SELECT u.userId, list(coalesce(cm.r, {_ZERO}) ORDER BY v.cluster) AS cluster_rating
       FROM cu u CROSS JOIN cv v LEFT JOIN cm ON cm.userId = u.userId AND cm.cluster = v.cluster GROUP BY u.userId),
d AS (SELECT userId, count(*) AS positive_count FROM pos GROUP BY userId)
SELECT coalesce(ga.userId, ca.userId, d.userId) AS userId,
       coalesce(ga.genre_share, (SELECT list({_ZERO}) FROM gv)) AS genre_share,
       coalesce(ca.cluster_rating, (SELECT list({_ZERO}) FROM cv)) AS cluster_rating,
       CAST(coalesce(d.positive_count, 0) AS BIGINT) AS positive_count
FROM ga FULL OUTER JOIN ca ON ga.userId = ca.userId
     FULL OUTER JOIN d ON coalesce(ga.userId, ca.userId) = d.userId""",
    headline=True,
)
def user_segment_matrix(spark, sf_dir):
    """R15."""
    return Fe.user_segment_matrix(fx.positive_ratings(spark, sf_dir, Fe.POSITIVE), fx.movies(spark, sf_dir),
                                  fx.item_clusters(spark, sf_dir))


def _content_sql(quantile: bool, split: bool) -> str:
    filt = (
        "q AS (SELECT quantile_cont(relevance, 0.75) AS t FROM genome_scores),\n"
        "s AS (SELECT g.* FROM genome_scores g, q WHERE relevance >= t),"
        if quantile else "s AS (SELECT * FROM genome_scores),"
    )
    split_sql = f"CASE WHEN {_HASH.format(k='s.tagId')} < 2 THEN 'test' ELSE 'train' END" if split else "'all'"
    return f"""{V('genome_scores', 'genome_tags')},
{filt}
n AS (SELECT count(DISTINCT movieId) AS n FROM s),
pt AS (SELECT tagId,
              CASE WHEN count(DISTINCT movieId) < (SELECT n FROM n) THEN least(min(relevance), {_ZERO}) ELSE min(relevance) END AS lo,
              greatest(max(relevance), {_ZERO}) AS hi
       FROM s GROUP BY tagId)
SELECT s.movieId, s.tagId, t.tag, {split_sql} AS split,
       round((s.relevance - pt.lo) / CASE WHEN pt.hi - pt.lo = 0 THEN {_ONE} ELSE pt.hi - pt.lo END, 6) AS value
FROM s JOIN pt ON s.tagId = pt.tagId JOIN genome_tags t ON s.tagId = t.tagId"""


@register("content_matrix", _content_sql(True, True))
def content_matrix(spark, sf_dir):
    """R16 (column split variant): quantile filter, 0-filled pivot, tag names, 80/20 tag split, min-max."""
    return Fe.content_matrix(fx.genome_scores(spark, sf_dir), fx.genome_tags(spark, sf_dir), 0.75, True)


@register("content_matrix_raw", _content_sql(False, False))
def content_matrix_raw(spark, sf_dir):
    """R16 (raw variant): every score, min-max per tag."""
    return Fe.content_matrix(fx.genome_scores(spark, sf_dir), fx.genome_tags(spark, sf_dir), None, False)


@register(
    "split_tags",
    f"{V('genome_scores')} SELECT DISTINCT tagId, CASE WHEN {_HASH.format(k='tagId')} < 2 THEN 'test' ELSE 'train' END AS split FROM genome_scores",
)
def split_tags(spark, sf_dir):
    """M4b."""
    return Fe.tag_split(fx.genome_scores(spark, sf_dir).select("tagId"))


@register(
    "split_rows",
    f"{V('movies')} SELECT movieId, CASE WHEN {_HASH.format(k='movieId')} < 2 THEN 'test' ELSE 'train' END AS split FROM movies",
)
def split_rows(spark, sf_dir):
    """train/test ids by md5 bucket (identical in Spark and DuckDB)."""
    return Fe.row_split(fx.movies(spark, sf_dir).select("movieId"), "movieId")


_LONG_VEC = "l AS (SELECT id, unnest(range(len(vec))) AS pos, unnest(vec) AS x FROM item_vectors)"


@register(
    "dim_stats",
    f"""{V('item_vectors')}, {_LONG_VEC}
SELECT CAST(pos AS INTEGER) AS pos, min(x) AS min, max(x) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std
FROM l GROUP BY pos""",
)
def dim_stats(spark, sf_dir):
    """Per-dimension min / max / mean / population std."""
    st = Vec.dim_stats(fx.item_vectors(spark, sf_dir))
    z = st.select(F.posexplode(F.arrays_zip("mins", "maxs", "means", "stds")).alias("pos", "s"))
    return z.select(
        "pos", F.col("s.mins").alias("min"), F.col("s.maxs").alias("max"),
        F.round("s.means", 6).alias("mean"), F.round("s.stds", 6).alias("std"))


@register(
    "minmax_scale",
    f"""{V('item_vectors')}, {_LONG_VEC},
st AS (SELECT pos, min(x) AS mn, max(x) AS mx FROM l GROUP BY pos)
SELECT l.id, list(round((l.x - st.mn) / CASE WHEN st.mx - st.mn = 0 THEN {_ONE} ELSE st.mx - st.mn END, 6) ORDER BY l.pos) AS scaled
FROM l JOIN st ON l.pos = st.pos GROUP BY l.id""",
)
def minmax_scale(spark, sf_dir):
    """M1."""
    out = Vec.minmax_scale(fx.item_vectors(spark, sf_dir))
    return out.select("id", Vec.round_vec("scaled").alias("scaled"))


@register(
    "standard_scale",
    f"""{V('item_vectors')}, {_LONG_VEC},
st AS (SELECT pos, avg(x) AS mu, stddev_pop(x) AS sd FROM l GROUP BY pos)
SELECT l.id, list(round((l.x - st.mu) / CASE WHEN st.sd = 0 THEN {_ONE} ELSE st.sd END, 6) ORDER BY l.pos) AS scaled
FROM l JOIN st ON l.pos = st.pos GROUP BY l.id""",
)
def standard_scale(spark, sf_dir):
    """M2 (population std)."""
    out = Vec.standard_scale(fx.item_vectors(spark, sf_dir))
    return out.select("id", Vec.round_vec("scaled").alias("scaled"))


@register(
    "constant_dims",
    f"""{V('item_vectors')}, {_LONG_VEC}
SELECT CAST(pos AS INTEGER) AS pos FROM l GROUP BY pos HAVING stddev_pop(x) < 0.0001""",
)
def constant_dims(spark, sf_dir):
    """P16."""
    return Vec.constant_dims(fx.item_vectors(spark, sf_dir)).select("pos")


@register(
    "segment_features",
    f"""{V('ratings', 'movies')},
pop AS (SELECT movieId, avg(rating) AS mean_rating, count(rating) AS rating_count FROM ratings GROUP BY movieId),
cls AS (SELECT list_sort(list_distinct(flatten(list(string_split(genres, '|'))))) AS c FROM movies),
raw AS (SELECT m.movieId,
               list_concat([CAST(coalesce(p.mean_rating, 0) AS DOUBLE), CAST(coalesce(p.rating_count, 0) AS DOUBLE)],
                           list_transform(c, lambda x: CASE WHEN list_contains(string_split(m.genres, '|'), x) THEN {_ONE} ELSE {_ZERO} END)) AS raw
        FROM movies m LEFT JOIN pop p ON m.movieId = p.movieId, cls),
l AS (SELECT movieId, unnest(range(len(raw))) AS pos, unnest(raw) AS x FROM raw),
st AS (SELECT pos, avg(x) AS mu, stddev_pop(x) AS sd FROM l GROUP BY pos)
SELECT l.movieId, list(round((l.x - st.mu) / CASE WHEN st.sd = 0 THEN {_ONE} ELSE st.sd END, 6) ORDER BY l.pos) AS features
FROM l JOIN st ON l.pos = st.pos GROUP BY l.movieId""",
)
def segment_features(spark, sf_dir):
    """M3."""
    return Fe.segment_features(fx.movies(spark, sf_dir), fx.ratings(spark, sf_dir))


@register(
    "hybrid_vector",
    f"""{V('item_vectors')}, {_LONG_VEC},
st AS (SELECT pos, min(x) AS mn, max(x) AS mx FROM l GROUP BY pos),
sc AS (SELECT l.id, list((l.x - st.mn) / CASE WHEN st.mx - st.mn = 0 THEN {_ONE} ELSE st.mx - st.mn END ORDER BY l.pos) AS s
       FROM l JOIN st ON l.pos = st.pos GROUP BY l.id)
SELECT v.id, list_transform(list_concat(v.vec, sc.s), lambda x: round(x, 6)) AS vec FROM item_vectors v JOIN sc ON v.id = sc.id""",
)
def hybrid_vector(spark, sf_dir):
    """Content vector || second vector set per entity (inner join on id);
    the second set here is the min-max scaled copy standing in for ALS factors."""
    iv = fx.item_vectors(spark, sf_dir)
    scaled = Vec.minmax_scale(iv).select("id", F.col("scaled").alias("vec"))
    out = Vec.concat_vectors(iv, scaled)
    return out.select("id", Vec.round_vec("vec").alias("vec"))


@register(
    "user_cluster_wide",
    f"""{V('ratings', 'item_clusters')},
pos AS (SELECT userId, movieId, rating FROM ratings WHERE rating > 3.5),
cm AS (SELECT p.userId, c.cluster, avg(p.rating) AS r FROM pos p JOIN item_clusters c ON p.movieId = c.movieId GROUP BY 1, 2)
SELECT userId, {', '.join(f"coalesce(max(CASE WHEN cluster = {k} THEN r END), CAST(0 AS DOUBLE)) AS cluster_rating_{k}" for k in range(10))}
FROM cm GROUP BY userId""",
)
def user_cluster_wide(spark, sf_dir):
    """Mean positive rating per item cluster as prefixed wide columns (cluster_rating_<k>),
    0-filled; the pivot values are the item-cluster dictionary (bounded by the number of clusters)."""
    pos = fx.positive_ratings(spark, sf_dir, Fe.POSITIVE)
    ic = fx.item_clusters(spark, sf_dir)
    cm = pos.join(ic, "movieId").groupBy("userId", "cluster").agg(F.avg("rating").alias("r"))
    ks = [r.cluster for r in ic.select("cluster").distinct().orderBy("cluster").collect()]  # dictionary, not facts
    wide = cm.groupBy("userId").pivot("cluster", ks).agg(F.first("r"))
    return wide.select("userId", *[F.coalesce(F.col(str(k)), F.lit(0.0)).alias(f"cluster_rating_{k}") for k in ks])
