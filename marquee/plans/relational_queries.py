"""Registered relational queries: sources, filters, joins, aggregates, ranking,
set operations and scalar functions (SURVEY §2.1-2.8), each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.functions import columns as C
from marquee.operators import neighbours as N
from marquee.operators import recommend as R
from marquee.operators import relational as Rel
from marquee.operators import vectors as Vec
from marquee.plans.catalog import register
from marquee.sources import fixtures as fx
from marquee.sources import io as sio
from marquee.sources.batches import BatchTable, IdDictionary

V = fx.with_views
_GENRE_SQL = " + ".join(f"(CASE WHEN instr(lower(genres), '{g}') > 0 THEN 1 ELSE 0 END)" for g in fx.APP_GENRES)
POSITIVE = 3.5


# --------------------------------------------------------------- R1 cold start
def _cold_start_sql(genre_sql: str, top_n: int, m: int) -> str:
    return f"""{V('ratings', 'movies')},
pop AS (SELECT movieId, avg(rating) AS ave_rating, count(rating) AS rating_count FROM ratings GROUP BY movieId),
merged AS (SELECT m.movieId, m.title, m.genres, p.ave_rating, p.rating_count, {genre_sql} AS genre_match
           FROM movies m JOIN pop p ON m.movieId = p.movieId),
stats AS (SELECT avg(ave_rating) AS C, max(genre_match > 0) AS any_match FROM merged),
cand AS (SELECT * FROM merged WHERE genre_match > 0
         UNION ALL
         SELECT * FROM (SELECT * FROM merged WHERE NOT (SELECT any_match FROM stats) ORDER BY movieId LIMIT {top_n}))
SELECT movieId, title, genres, ave_rating, rating_count,
       round(rating_count / (rating_count + {m}) * ave_rating + {m} / (rating_count + {m}) * C, 6) AS weighted_rating
FROM cand, stats ORDER BY weighted_rating DESC, movieId LIMIT {top_n}"""


@register("cold_start_genres", _cold_start_sql(_GENRE_SQL, 10, 50), headline=True)
def cold_start_genres(spark, sf_dir):
    """R1 flagship: app genres, top 10, m = 50."""
    return R.cold_start_by_genres(
        fx.movies(spark, sf_dir), fx.ratings(spark, sf_dir), fx.APP_GENRES, top_n=10, min_votes=50
    )


_NO_GENRE = "western"


@register(
    "cold_start_fallback",
    _cold_start_sql(f"(CASE WHEN instr(lower(genres), '{_NO_GENRE}') > 0 THEN 1 ELSE 0 END)", 10, 10),
)
def cold_start_fallback(spark, sf_dir):
    """R1 with a genre that matches nothing: the fallback list."""
    return R.cold_start_by_genres(
        fx.movies(spark, sf_dir), fx.ratings(spark, sf_dir), [_NO_GENRE], top_n=10, min_votes=10
    )


# -------------------------------------------------------------------- sources
@register("scan_movies", f"{V('movies')} SELECT * FROM movies")
def scan_movies(spark, sf_dir):
    return fx.movies(spark, sf_dir)


@register("scan_ratings", f"{V('ratings')} SELECT userId, movieId, rating, CAST(\"timestamp\" AS BIGINT) AS \"timestamp\" FROM ratings")
def scan_ratings(spark, sf_dir):
    return fx.ratings(spark, sf_dir)


@register("scan_scores", f"{V('genome_scores')} SELECT * FROM genome_scores")
def scan_scores(spark, sf_dir):
    return fx.genome_scores(spark, sf_dir)


@register("scan_tags", f"{V('genome_tags')} SELECT * FROM genome_tags")
def scan_tags(spark, sf_dir):
    return fx.genome_tags(spark, sf_dir)


@register(
    "parse_id_list",
    """WITH t AS (SELECT l_orderkey AS orderkey, l_linenumber AS ln,
                  CAST(l_partkey AS VARCHAR) || ', ' || l_returnflag || ',' || CAST(l_suppkey AS VARCHAR) || ' , x' || CAST(l_linenumber AS VARCHAR) AS txt
               FROM lineitem),
    p AS (SELECT orderkey, ln, trim(unnest(string_split(txt, ','))) AS tok FROM t)
SELECT orderkey, ln, CAST(tok AS BIGINT) AS movieId FROM p WHERE regexp_full_match(tok, '[0-9]+')""",
)
def parse_id_list(spark, sf_dir):
    """Free-text id lists (ids mixed with flags and junk tokens, one text per order line) -> id rows."""
    li = fx.table(spark, sf_dir, "lineitem")
    txt = F.concat(F.col("l_partkey").cast("string"), F.lit(", "), F.col("l_returnflag"), F.lit(","),
                   F.col("l_suppkey").cast("string"), F.lit(" , x"), F.col("l_linenumber").cast("string"))
    return li.select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("ln"),
                     F.explode(C.parse_id_list(txt)).alias("movieId"))


@register(
    "ratings_map",
    """WITH o AS (SELECT l_orderkey AS orderkey, l_linenumber AS ln, l_partkey AS k1, l_suppkey AS k2,
                  CAST(ceil(l_quantity / 5) AS DOUBLE) / CAST(2 AS DOUBLE) AS r1, l_discount * 100 AS r2 FROM lineitem)
SELECT orderkey, ln, k1 AS movieId, r1 AS rating FROM o WHERE k1 <> k2
UNION ALL SELECT orderkey, ln, k2, r2 FROM o""",
)
def ratings_map(spark, sf_dir):
    """Zip an id list with a rating list into an id -> rating map (lengths must agree, a
    repeated id keeps its last value); one map per order line, entries returned as rows."""
    li = fx.table(spark, sf_dir, "lineitem")
    ids = F.array(F.col("l_partkey"), F.col("l_suppkey"))
    vals = F.array(fx.rating_expr(F.col("l_quantity")), F.col("l_discount") * 100)
    m = li.select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("ln"),
                  C.ratings_map(ids, vals).alias("m"))
    return m.select("orderkey", "ln", F.explode("m").alias("movieId", "rating"))


@register(
    "normalize_genres",
    f"""{V('movies')}, g AS (SELECT DISTINCT trim(unnest(string_split(genres, '|'))) AS name FROM movies)
SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS genre_id, name FROM g""",
)
def normalize_genres(spark, sf_dir):
    """Genre dimension with 1-based surrogate ids in name order."""
    g = Rel.distinct_tokens(fx.movies(spark, sf_dir), "genres", "name")
    return Rel.dense_index(g, "name", "genre_id").select((F.col("genre_id") + 1).alias("genre_id"), "name")


@register(
    "normalize_movie_genres",
    f"""{V('movies')}, g AS (SELECT DISTINCT trim(unnest(string_split(genres, '|'))) AS name FROM movies),
d AS (SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS genre_id, name FROM g),
mg AS (SELECT DISTINCT movieId, trim(unnest(string_split(genres, '|'))) AS name FROM movies)
SELECT mg.movieId, d.genre_id FROM mg JOIN d ON mg.name = d.name""",
)
def normalize_movie_genres(spark, sf_dir):
    """Movie <-> genre bridge by one equi-join (the dimension is broadcast)."""
    mv = fx.movies(spark, sf_dir)
    dim = normalize_genres(spark, sf_dir)
    mg = mv.select("movieId", F.explode(C.genre_tokens("genres")).alias("_g")).select(
        "movieId", F.trim("_g").alias("name")).distinct()
    return mg.join(F.broadcast(dim), "name").select("movieId", "genre_id")


@register("normalize_users", f"{V('ratings')} SELECT DISTINCT userId AS user_id FROM ratings")
def normalize_users(spark, sf_dir):
    return fx.ratings(spark, sf_dir).select(F.col("userId").alias("user_id")).distinct()


# ----------------------------------------------------------------- predicates
@register(
    "quantile_filter",
    f"""{V('genome_scores')}, q AS (SELECT quantile_cont(relevance, 0.75) AS t FROM genome_scores)
SELECT movieId, tagId, relevance FROM genome_scores, q WHERE relevance >= t""",
)
def quantile_filter(spark, sf_dir):
    """Keep relevance >= exact q0.75 (inclusive)."""
    gs = fx.genome_scores(spark, sf_dir)
    q = Rel.scalar_quantile(gs, "relevance", 0.75, "_t")
    return Rel.with_scalars(gs, q).where(F.col("relevance") >= F.col("_t")).drop("_t")


@register("positive_ratings", f"{V('ratings')} SELECT userId, movieId, rating FROM ratings WHERE rating > 3.5")
def positive_ratings(spark, sf_dir):
    return fx.positive_ratings(spark, sf_dir, POSITIVE).select("userId", "movieId", "rating")


@register(
    "movie_lookup",
    f"{V('movies', 'seeds')} SELECT s.request_id, m.movieId, m.title, m.genres FROM seeds s JOIN movies m ON s.movieId = m.movieId",
)
def movie_lookup(spark, sf_dir):
    """P5: point lookups by a request table (broadcast)."""
    return F.broadcast(fx.seed_requests(spark)).join(fx.movies(spark, sf_dir), "movieId").select(
        "request_id", "movieId", "title", "genres")


@register("title_search", f"{V('movies')} SELECT movieId, title FROM movies WHERE regexp_matches(title, '(?i)R.ng')")
def title_search(spark, sf_dir):
    """Case-insensitive regex search on title (null title = no match)."""
    return R.title_search(fx.movies(spark, sf_dir), "R.ng").select("movieId", "title")


@register("genre_match", f"{V('movies')} SELECT movieId, {_GENRE_SQL} AS genre_match FROM movies")
def genre_match(spark, sf_dir):
    return fx.movies(spark, sf_dir).select("movieId", C.genre_match_count("genres", fx.APP_GENRES).alias("genre_match"))


@register(
    "ratings_with_vectors",
    f"""{V('ratings', 'item_vectors', 'user_vectors')}
SELECT userId, movieId, rating FROM ratings
WHERE movieId IN (SELECT id FROM item_vectors) AND userId IN (SELECT id FROM user_vectors)""",
)
def ratings_with_vectors(spark, sf_dir):
    """Ratings whose user and item both have a vector (two semi joins)."""
    r = fx.ratings(spark, sf_dir).select("userId", "movieId", "rating")
    r = r.join(fx.item_vectors(spark, sf_dir).select(F.col("id").alias("movieId")), "movieId", "left_semi")
    return r.join(fx.user_vectors(spark, sf_dir).select(F.col("id").alias("userId")), "userId", "left_semi")


@register(
    "unknown_users",
    f"{V('user_vectors', 'user_clusters')} SELECT id FROM user_vectors WHERE id NOT IN (SELECT user_id FROM user_clusters)",
)
def unknown_users(spark, sf_dir):
    """Requested users without a segment (reported, not raised)."""
    return fx.user_vectors(spark, sf_dir).select("id").join(
        fx.user_clusters(spark, sf_dir).select(F.col("user_id").alias("id")), "id", "left_anti")


@register(
    "genres_split",
    f"{V('movies')} SELECT movieId, string_split(genres, '|') AS genre_list FROM movies",
)
def genres_split(spark, sf_dir):
    return fx.movies(spark, sf_dir).select("movieId", C.genre_tokens("genres").alias("genre_list"))


@register(
    "genres_explode",
    f"{V('movies')} SELECT movieId, trim(lower(unnest(string_split(genres, '|')))) AS genre FROM movies",
)
def genres_explode(spark, sf_dir):
    """Explode, trim, lower."""
    return fx.movies(spark, sf_dir).select("movieId", F.explode(C.genre_tokens("genres")).alias("g")).select(
        "movieId", F.trim(F.lower("g")).alias("genre"))


@register(
    "distinct_genres",
    f"{V('movies')} SELECT DISTINCT trim(unnest(string_split(genres, '|'))) AS genre FROM movies ORDER BY genre",
)
def distinct_genres(spark, sf_dir):
    """Sorted."""
    return Rel.distinct_tokens(fx.movies(spark, sf_dir)).orderBy("genre")


# ---------------------------------------------------------------------- joins
_POP_SQL = "pop AS (SELECT movieId, avg(rating) AS ave_rating, count(rating) AS rating_count FROM ratings GROUP BY movieId)"


@register("popularity", f"{V('ratings')}, {_POP_SQL} SELECT * FROM pop", headline=True)
def popularity(spark, sf_dir):
    """A1: mean rating and count per movie."""
    return Rel.popularity(fx.ratings(spark, sf_dir))


@register(
    "join_inner_popularity",
    f"{V('ratings', 'movies')}, {_POP_SQL} SELECT m.movieId, m.title, m.genres, p.ave_rating, p.rating_count FROM movies m JOIN pop p ON m.movieId = p.movieId",
)
def join_inner_popularity(spark, sf_dir):
    return fx.movies(spark, sf_dir).join(Rel.popularity(fx.ratings(spark, sf_dir)), "movieId")


# Ratings of few users leave most movies unrated; movies with holes have null titles and genres.
_FEW = "few AS (SELECT * FROM ratings WHERE userId < 50), pop AS (SELECT movieId, avg(rating) AS ave_rating, count(rating) AS rating_count FROM few GROUP BY movieId)"
_HOLES = """holes AS (SELECT movieId, CASE WHEN movieId % 11 <> 0 THEN title END AS title, CASE WHEN movieId % 13 <> 0 THEN genres END AS genres FROM movies)"""


def _few_ratings(spark, sf_dir):
    return fx.ratings(spark, sf_dir).where(F.col("userId") < 50)


def _movies_with_holes(spark, sf_dir):
    return fx.movies(spark, sf_dir).select(
        "movieId", F.when(F.col("movieId") % 11 != 0, F.col("title")).alias("title"),
        F.when(F.col("movieId") % 13 != 0, F.col("genres")).alias("genres"))


@register(
    "unrated_stats",
    f"""{V('ratings', 'movies')}, {_FEW}
SELECT m.movieId, coalesce(p.ave_rating, 0) AS ave_rating, coalesce(p.rating_count, 0) AS rating_count,
       round((SELECT avg(ave_rating) FROM pop), 6) AS mean_rated,
       round((SELECT avg(coalesce(p2.ave_rating, 0)) FROM movies m2 LEFT JOIN pop p2 ON m2.movieId = p2.movieId), 6) AS mean_all
FROM movies m LEFT JOIN pop p ON m.movieId = p.movieId""",
)
def unrated_stats(spark, sf_dir):
    """J2, P12, A2 where most movies have no rating: zero-filled stats, and the two means that then differ."""
    pop = Rel.popularity(_few_ratings(spark, sf_dir))
    every = Rel.left_fill(fx.movies(spark, sf_dir).select("movieId"), pop, "movieId", {"ave_rating": 0.0, "rating_count": 0})
    means = pop.agg(F.round(F.avg("ave_rating"), 6).alias("mean_rated")).crossJoin(
        every.agg(F.round(F.avg("ave_rating"), 6).alias("mean_all")))
    return Rel.with_scalars(every, means)


@register(
    "catalogue_with_holes",
    f"""{V('movies')}, {_HOLES}
SELECT movieId, title, genres, title IS NOT NULL AND genres IS NOT NULL AS usable,
       len(string_split(genres, '|')) AS n_genres, instr(lower(coalesce(genres, '')), 'small') > 0 AS is_small,
       coalesce(regexp_matches(title, '(?i)r.ng'), false) AS found
FROM holes""",
)
def catalogue_with_holes(spark, sf_dir):
    """P11, P14, P15, P7 on null titles and genres: usable as a result, genre tokens, genre match, title search."""
    mv = _movies_with_holes(spark, sf_dir)
    usable = N.catalogue(mv).select("movieId", F.lit(True).alias("_u"))
    found = R.title_search(mv, "R.ng").select("movieId", F.lit(True).alias("_f"))
    x = mv.join(usable, "movieId", "left").join(found, "movieId", "left")
    return x.select("movieId", "title", "genres", F.coalesce("_u", F.lit(False)).alias("usable"),
                    F.when(F.col("genres").isNotNull(), F.size(C.genre_tokens("genres"))).cast("bigint").alias("n_genres"),
                    (C.genre_match_count("genres", ["small"]) > 0).alias("is_small"), F.coalesce("_f", F.lit(False)).alias("found"))


@register(
    "requests_unknown",
    f"""{V('ratings', 'user_clusters')}, rq AS (SELECT DISTINCT userId AS id FROM ratings UNION SELECT DISTINCT -userId - 1 FROM ratings)
SELECT id FROM rq WHERE id NOT IN (SELECT user_id FROM user_clusters)""",
)
def requests_unknown(spark, sf_dir):
    """Of requests for every user and for as many ids that don't exist, the unknown ones are reported."""
    ids = fx.ratings(spark, sf_dir).select(F.col("userId").alias("id"))
    req = ids.union(ids.select(-F.col("id") - 1)).distinct()
    return Rel.anti(req, fx.user_clusters(spark, sf_dir).select(F.col("user_id").alias("id")), "id")


@register(
    "constant_dims_found",
    f"{V('item_vectors')} SELECT CAST(p AS INTEGER) AS pos, CAST(0 AS DOUBLE) AS std FROM (SELECT max(len(vec)) AS d FROM item_vectors), unnest([0, 1]) t(k), LATERAL (SELECT d + k AS p)",
)
def constant_dims_found(spark, sf_dir):
    """Two constant dimensions behind the content vector are found."""
    iv = fx.item_vectors(spark, sf_dir).select("id", F.concat("vec", F.array(F.lit(0.5), F.lit(-3.0))).alias("vec"))
    return Vec.constant_dims(iv).select("pos", F.round("std", 6).alias("std"))


@register("csv_sources", " UNION ALL ".join(
    f"(WITH x AS ({V(view)} SELECT * FROM {view}) SELECT '{kind}' AS kind, count(*) AS n_rows, 0::BIGINT AS changed FROM x)"
    for kind, view in (("movies", "movies"), ("ratings", "ratings"), ("genome-scores", "genome_scores"), ("genome-tags", "genome_tags"))))
def csv_sources(spark, sf_dir):
    """The four inputs written as CSV to the shared folder and read with their explicit schemas; no row changes."""
    out = None
    for kind, source in (("movies", fx.movies), ("ratings", fx.ratings), ("genome-scores", fx.genome_scores), ("genome-tags", fx.genome_tags)):
        df = source(spark, sf_dir)
        again = sio.read_csv(spark, sio.write_table(df, f"csv-{kind}", "csv"), kind)
        changed = df.exceptAll(again).agg(F.count(F.lit(1)).alias("changed"))
        row = again.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n_rows")).crossJoin(changed)
        out = row if out is None else out.unionByName(row)
    return out


@register(
    "normalize_ratings",
    f"""{V('ratings')} SELECT row_number() OVER (ORDER BY userId, movieId, "timestamp", rating) AS rating_id, userId AS user_id, movieId AS movie_id, rating FROM ratings""",
)
def normalize_ratings(spark, sf_dir):
    """The ratings table with surrogate ids in key order, written and read back."""
    r = fx.ratings(spark, sf_dir)
    order = [F.col(c).asc() for c in ("userId", "movieId", "timestamp", "rating")]
    t = Rel.running_total(r, order, None, "rating_id").select(
        "rating_id", F.col("userId").alias("user_id"), F.col("movieId").alias("movie_id"), "rating")
    return sio.roundtrip_parquet(t, "ratings-table")


@register(
    "load_ratings_batches",
    f"""{V('ratings')}, one AS (SELECT userId, movieId, min(rating) AS rating, min("timestamp") AS first FROM ratings GROUP BY userId, movieId)
SELECT count(*) AS rows, min(1) AS first_id, count(*) AS last_id, count(DISTINCT userId) AS users, sum(movieId)::BIGINT AS items, 4 AS batches, 0 AS loaded_again FROM one""",
)
def load_ratings_batches(spark, sf_dir):
    """Ratings (one a user and movie) loaded in four numbered batches with reserved surrogate ids, then once more in vain."""
    one = fx.ratings(spark, sf_dir).groupBy("userId", "movieId").agg(F.min("rating").alias("rating"))
    one = sio.roundtrip_parquet(one, "ratings-once")
    table = BatchTable(spark, sio.shared_path(spark, "ratings-batches"), one.schema, ["userId", "movieId"], "rating_id")
    size = -(-one.count() // 4)
    batches = table.load_all(one, ["userId", "movieId"], size)
    again = sum(table.load(b, one) for b in range(batches))
    x = table.read()
    return x.agg(F.count("*").alias("rows"), F.min("rating_id").cast("int").alias("first_id"), F.max("rating_id").alias("last_id"),
                 F.countDistinct("userId").alias("users"), F.sum("movieId").alias("items"), F.lit(batches).alias("batches"), F.lit(again).alias("loaded_again"))


@register(
    "encode_append_encode",
    f"""{V('ratings')}, f AS (SELECT DISTINCT userId AS id FROM ratings WHERE userId % 3 > 0), a AS (SELECT DISTINCT userId AS id FROM ratings),
c AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS code FROM f
      UNION ALL SELECT id, (SELECT count(*) FROM f) + row_number() OVER (ORDER BY id) - 1 FROM a WHERE id NOT IN (SELECT id FROM f))
SELECT userId, movieId, code AS user_idx, rating FROM ratings JOIN c ON userId = id""",
)
def encode_append_encode(spark, sf_dir):
    """An id dictionary of two thirds of the users, appended to with all of them; old codes stay."""
    r = fx.ratings(spark, sf_dir)
    ids = IdDictionary(spark, sio.shared_path(spark, "user-codes"))
    ids.append(1, r.where("userId % 3 > 0"), "userId")
    ids.append(2, r, "userId")
    ids.append(1, r, "userId")  # a replay
    return ids.encode(r, "userId", "user_idx").select("userId", "movieId", "user_idx", "rating")


@register(
    "normalize_scores",
    f"{V('genome_scores')} SELECT row_number() OVER (ORDER BY movieId, tagId) AS score_id, movieId AS movie_id, tagId AS tag_id, relevance FROM genome_scores",
)
def normalize_scores(spark, sf_dir):
    """The tag scores with surrogate ids, written and read back."""
    t = Rel.running_total(fx.genome_scores(spark, sf_dir), [F.col("movieId").asc(), F.col("tagId").asc()], None, "score_id")
    return sio.roundtrip_parquet(t.select("score_id", F.col("movieId").alias("movie_id"), F.col("tagId").alias("tag_id"), "relevance"), "scores-table")


@register(
    "normalize_tags",
    f"{V('genome_tags')} SELECT tagId AS tag_id, tag AS name FROM genome_tags",
)
def normalize_tags(spark, sf_dir):
    """The tag table, written and read back."""
    return sio.roundtrip_parquet(fx.genome_tags(spark, sf_dir).select(F.col("tagId").alias("tag_id"), F.col("tag").alias("name")), "tags-table")


@register(
    "join_left_stats",
    f"""{V('ratings', 'item_vectors')}, {_POP_SQL}
SELECT v.id AS movieId, coalesce(p.ave_rating, 0) AS ave_rating, coalesce(p.rating_count, 0) AS rating_count
FROM item_vectors v LEFT JOIN pop p ON v.id = p.movieId""",
)
def join_left_stats(spark, sf_dir):
    """Left join + zero fill (vector ids without ratings get 0/0)."""
    ids = fx.item_vectors(spark, sf_dir).select(F.col("id").alias("movieId"))
    return Rel.left_fill(ids, Rel.popularity(fx.ratings(spark, sf_dir)), "movieId",
                         {"ave_rating": 0.0, "rating_count": 0})


@register(
    "join_ratings_genres",
    f"""{V('ratings', 'movies')}
SELECT r.userId, r.movieId, r.rating, g.genre FROM ratings r JOIN
 (SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM movies) g ON r.movieId = g.movieId
WHERE r.rating > 3.5""",
)
def join_ratings_genres(spark, sf_dir):
    """Positive ratings fanned out to one row per genre."""
    return R.positive_with_genres(fx.positive_ratings(spark, sf_dir, POSITIVE), fx.movies(spark, sf_dir), POSITIVE)


@register(
    "join_ratings_clusters",
    f"{V('ratings', 'item_clusters')} SELECT r.userId, r.movieId, r.rating, c.cluster FROM ratings r JOIN item_clusters c ON r.movieId = c.movieId WHERE r.rating > 3.5",
)
def join_ratings_clusters(spark, sf_dir):
    """Item -> cluster map is one row per item; broadcast below the size threshold (AQE decides)."""
    r = fx.positive_ratings(spark, sf_dir, POSITIVE).select("userId", "movieId", "rating")
    return r.join(fx.item_clusters(spark, sf_dir), "movieId")


@register(
    "importance_last",
    f"{V('importance')} SELECT movieId, arg_max(importance_score, seq) AS importance_score FROM importance GROUP BY movieId",
)
def importance_last(spark, sf_dir):
    """Last write wins per movie."""
    return Rel.keep_last(fx.importance(spark, sf_dir), "movieId", "seq")


@register(
    "promoted_items",
    f"""{V('importance', 'movies')}, last AS (SELECT movieId, arg_max(importance_score, seq) AS s FROM importance GROUP BY movieId)
SELECT m.movieId, m.title, m.genres FROM last JOIN movies m ON last.movieId = m.movieId WHERE s = 1""",
)
def promoted_items(spark, sf_dir):
    """Promoted ids that exist in the catalogue."""
    return R.promoted_items(fx.importance(spark, sf_dir), fx.movies(spark, sf_dir))


@register(
    "semi_cluster_users",
    f"""{V('ratings', 'user_clusters')}
SELECT userId, movieId, rating FROM ratings WHERE userId IN
 (SELECT user_id FROM user_clusters WHERE cluster IN (SELECT cluster FROM user_clusters WHERE user_id = 1))""",
)
def semi_cluster_users(spark, sf_dir):
    """Ratings of the members of user 1's segment."""
    uc = fx.user_clusters(spark, sf_dir)
    members = uc.join(uc.where(F.col("user_id") == 1).select("cluster"), "cluster", "left_semi")
    return fx.ratings(spark, sf_dir).select("userId", "movieId", "rating").join(
        members.select(F.col("user_id").alias("userId")), "userId", "left_semi")


@register(
    "anti_blocked",
    f"""{V('ratings', 'importance')}, {_POP_SQL},
last AS (SELECT movieId, arg_max(importance_score, seq) AS s FROM importance GROUP BY movieId)
SELECT * FROM pop WHERE movieId NOT IN (SELECT movieId FROM last WHERE s = -1)""",
)
def anti_blocked(spark, sf_dir):
    """Drop blocked movies by anti join (never NOT IN on a nullable column)."""
    return R.drop_blocked(Rel.popularity(fx.ratings(spark, sf_dir)), fx.importance(spark, sf_dir), "movieId")


@register(
    "tag_names",
    f"{V('genome_scores', 'genome_tags')} SELECT s.movieId, t.tag, s.relevance FROM genome_scores s JOIN genome_tags t ON s.tagId = t.tagId",
)
def tag_names(spark, sf_dir):
    """Dictionary lookup tagId -> tag (dictionary broadcast)."""
    return fx.genome_scores(spark, sf_dir).join(F.broadcast(fx.genome_tags(spark, sf_dir)), "tagId").select(
        "movieId", "tag", "relevance")


@register(
    "label_encode",
    f"{V('ratings')} SELECT movieId, CAST(dense_rank() OVER (ORDER BY movieId) - 1 AS BIGINT) AS idx FROM (SELECT DISTINCT movieId FROM ratings)",
)
def label_encode(spark, sf_dir):
    """0-based codes over sorted distinct ids."""
    return Rel.dense_index(fx.ratings(spark, sf_dir).select("movieId"), "movieId", "idx")


@register(
    "encode_ids",
    f"""{V('ratings')}, u AS (SELECT userId, CAST(dense_rank() OVER (ORDER BY userId) - 1 AS BIGINT) AS user_idx FROM (SELECT DISTINCT userId FROM ratings)),
i AS (SELECT movieId, CAST(dense_rank() OVER (ORDER BY movieId) - 1 AS BIGINT) AS item_idx FROM (SELECT DISTINCT movieId FROM ratings))
SELECT r.userId, r.movieId, u.user_idx, i.item_idx, r.rating FROM ratings r JOIN u ON r.userId = u.userId JOIN i ON r.movieId = i.movieId""",
)
def encode_ids(spark, sf_dir):
    """Ratings with contiguous user/item codes (ALS needs int ids)."""
    r = fx.ratings(spark, sf_dir)
    u = Rel.dense_index(r.select("userId"), "userId", "user_idx")
    i = Rel.dense_index(r.select("movieId"), "movieId", "item_idx")
    return r.join(u, "userId").join(i, "movieId").select("userId", "movieId", "user_idx", "item_idx", "rating")


@register(
    "next_id",
    f"{V('ratings', 'movies')} SELECT (SELECT max(movieId) + 1 FROM movies) AS next_movie_id, (SELECT max(userId) + 1 FROM ratings) AS next_user_id",
)
def next_id(spark, sf_dir):
    """A12."""
    a = Rel.next_id(fx.movies(spark, sf_dir), "movieId", "next_movie_id")
    b = Rel.next_id(fx.ratings(spark, sf_dir), "userId", "next_user_id")
    return a.crossJoin(b)


# ----------------------------------------------------------------- aggregates
@register(
    "global_mean",
    f"""{V('ratings', 'movies')}, {_POP_SQL}
SELECT round((SELECT avg(ave_rating) FROM pop), 6) AS mean_rated,
       round((SELECT avg(coalesce(p.ave_rating, 0)) FROM movies m LEFT JOIN pop p ON m.movieId = p.movieId), 6) AS mean_all""",
)
def global_mean(spark, sf_dir):
    """A2: mean movie rating over rated movies, and over all movies counting unrated as 0."""
    pop = Rel.popularity(fx.ratings(spark, sf_dir))
    a = pop.agg(F.round(F.avg("ave_rating"), 6).alias("mean_rated"))
    allm = Rel.left_fill(fx.movies(spark, sf_dir).select("movieId"), pop, "movieId", {"ave_rating": 0.0})
    b = allm.agg(F.round(F.avg("ave_rating"), 6).alias("mean_all"))
    return a.crossJoin(b)


@register(
    "vote_quantiles",
    f"""{V('ratings')}, {_POP_SQL}
SELECT quantile_cont(rating_count, 0.6) AS q60, quantile_cont(rating_count, 0.5) AS median_votes,
       quantile_cont(ave_rating, 0.75) AS q75_rating FROM pop""",
)
def vote_quantiles(spark, sf_dir):
    """A3: exact quantiles with linear interpolation (not percentile_approx)."""
    pop = Rel.popularity(fx.ratings(spark, sf_dir))
    parts = [Rel.scalar_quantile(pop, c, p, name) for c, p, name in (
        ("rating_count", 0.6, "q60"), ("rating_count", 0.5, "median_votes"), ("ave_rating", 0.75, "q75_rating"))]
    return parts[0].crossJoin(parts[1]).crossJoin(parts[2])


@register(
    "interaction_matrix",
    f"{V('ratings')} SELECT userId, movieId, sum(rating) AS rating FROM ratings GROUP BY userId, movieId",
)
def interaction_matrix(spark, sf_dir):
    """Duplicate (user, item) cells summed."""
    return Rel.interaction_matrix(fx.ratings(spark, sf_dir))


@register(
    "weighted_rating",
    f"""{V('ratings')}, {_POP_SQL}, s AS (SELECT avg(ave_rating) AS C, quantile_cont(rating_count, 0.6) AS m FROM pop)
SELECT movieId, round(rating_count / (rating_count + m) * ave_rating + m / (rating_count + m) * C, 6) AS weighted_rating FROM pop, s""",
)
def weighted_rating(spark, sf_dir):
    """F10 with m = q0.60 of votes and C = mean rating."""
    pop = Rel.popularity(fx.ratings(spark, sf_dir))
    m = Rel.scalar_quantile(pop, "rating_count", 0.6, "_m")
    s = Rel.with_scalars(pop.agg(F.avg("ave_rating").alias("_C")), m)
    return Rel.with_scalars(pop, s).select(
        "movieId", F.round(C.weighted_rating("rating_count", "ave_rating", "_m", "_C"), 6).alias("weighted_rating"))


@register(
    "shrunk_rating",
    f"""{V('ratings')}, {_POP_SQL}, s AS (SELECT median(rating_count) AS m FROM pop)
SELECT movieId, round(rating_count / (rating_count + m) * ave_rating, 6) AS shrunk_rating FROM pop, s""",
)
def shrunk_rating(spark, sf_dir):
    """F10b with m = median votes."""
    pop = Rel.popularity(fx.ratings(spark, sf_dir))
    s = Rel.scalar_quantile(pop, "rating_count", 0.5, "_m")
    return Rel.with_scalars(pop, s).select(
        "movieId", F.round(C.shrunk_rating("rating_count", "ave_rating", "_m"), 6).alias("shrunk_rating"))


# -------------------------------------------------------------- ranking / top-k
@register(
    "topk_global",
    f"{V('ratings')}, {_POP_SQL} SELECT movieId, ave_rating, rating_count FROM pop ORDER BY ave_rating DESC, movieId LIMIT 10",
)
def topk_global(spark, sf_dir):
    """T1 global: distributed top-k (TakeOrderedAndProject)."""
    pop = Rel.popularity(fx.ratings(spark, sf_dir))
    return Rel.top_k(pop, [F.col("ave_rating").desc(), F.col("movieId").asc()], 10)


_USER_TOP_SQL = """im AS (SELECT userId, movieId, sum(rating) AS score FROM ratings GROUP BY userId, movieId),
ranked AS (SELECT userId, movieId, score, row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId) AS rank,
                  count(*) OVER (PARTITION BY userId) AS n_all FROM im)"""


@register(
    "topk_per_request",
    f"{V('ratings')}, {_USER_TOP_SQL} SELECT userId, movieId, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5",
)
def topk_per_request(spark, sf_dir):
    """T1 per request: every user's top 5 items by summed rating (WindowGroupLimit)."""
    im = Rel.interaction_matrix(fx.ratings(spark, sf_dir)).withColumnRenamed("rating", "score")
    return Rel.top_k_per_group(im, ["userId"], [F.col("score").desc(), F.col("movieId").asc()], 5)


@register(
    "rank_weights",
    f"""{V('ratings')}, {_USER_TOP_SQL},
top AS (SELECT userId, movieId, rank, least(n_all, 50) AS n FROM ranked WHERE rank <= 50)
SELECT userId, movieId, CAST(rank AS INTEGER) AS rank,
       CASE WHEN n <= 1 THEN 20.0 ELSE round_even(CAST(rank - 1 AS DOUBLE) * (-19.0 / CAST(n - 1 AS DOUBLE)) + 20.0, 0) END AS weight
FROM top""",
)
def rank_weights(spark, sf_dir):
    """Linear weights 20 -> 1 over each user's top-50 list (half-even rounding)."""
    im = Rel.interaction_matrix(fx.ratings(spark, sf_dir)).withColumnRenamed("rating", "score")
    return R.with_rank_weights(im, ["userId"], [F.col("score").desc(), F.col("movieId").asc()], 50).select(
        "userId", "movieId", "rank", "weight")


# ------------------------------------------------------------- set operations
@register(
    "list_intersect",
    f"{V('ratings', 'item_vectors')} SELECT movieId FROM ratings WHERE rating > 3.5 INTERSECT SELECT id FROM item_vectors",
)
def list_intersect(spark, sf_dir):
    """U2."""
    pos = fx.positive_ratings(spark, sf_dir, POSITIVE).select("movieId")
    return pos.intersect(fx.item_vectors(spark, sf_dir).select(F.col("id").alias("movieId")))


@register(
    "exclusion_set",
    f"{V('importance', 'seeds')} SELECT movieId FROM importance WHERE importance_score = -1 UNION SELECT movieId FROM seeds",
)
def exclusion_set(spark, sf_dir):
    """Blocked ids union seed ids, distinct."""
    blocked = fx.importance(spark, sf_dir).where(F.col("importance_score") == -1).select("movieId")
    return blocked.union(fx.seed_requests(spark).select("movieId")).distinct()


# ------------------------------------------------------------------- vectors I/O
@register(
    "multi_hot",
    f"""{V('movies')}, cls AS (SELECT list_sort(list_distinct(flatten(list(string_split(genres, '|'))))) AS c FROM movies)
SELECT movieId, list_transform(c, lambda x: CASE WHEN list_contains(string_split(genres, '|'), x) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS genre_vec
FROM movies, cls""",
)
def multi_hot(spark, sf_dir):
    """multi-hot over the sorted genre vocabulary (vocabulary is one small row, broadcast)."""
    mv = fx.movies(spark, sf_dir)
    return R.genre_multi_hot(mv).select("movieId", "genre_vec")


@register(
    "vectors_roundtrip",
    f"{V('item_vectors')} SELECT id, vec FROM item_vectors",
)
def vectors_roundtrip(spark, sf_dir):
    """Write (id, vec) parquet to the shared checkpoint folder and read it back."""
    return sio.roundtrip_parquet(fx.item_vectors(spark, sf_dir).select("id", "vec"), "vectors")


@register(
    "matrix_to_long",
    f"{V('item_vectors')} SELECT id AS movieId, CAST(unnest(range(len(vec))) AS BIGINT) AS tagId, unnest(vec) AS value FROM item_vectors",
)
def matrix_to_long(spark, sf_dir):
    """Dense rows -> long (movieId, tagId, value) by posexplode."""
    return sio.dense_to_long(fx.item_vectors(spark, sf_dir), "id", "vec", "movieId", "tagId", "value")


@register(
    "long_to_matrix",
    f"{V('genome_scores')} SELECT movieId, list(relevance ORDER BY tagId) AS vec FROM genome_scores GROUP BY movieId",
)
def long_to_matrix(spark, sf_dir):
    """S7 inverse: long facts -> dense array ordered by tagId (bounded by the tag count)."""
    return sio.long_to_dense(fx.genome_scores(spark, sf_dir), "movieId", "tagId", "relevance", "vec")


@register(
    "sparse_roundtrip",
    f"{V('ratings')} SELECT userId AS \"row\", movieId AS col, sum(rating) AS value FROM ratings GROUP BY userId, movieId",
)
def sparse_roundtrip(spark, sf_dir):
    """Sparse matrix as long (row, col, value) parquet, written and re-read."""
    im = Rel.interaction_matrix(fx.ratings(spark, sf_dir)).select(
        F.col("userId").alias("row"), F.col("movieId").alias("col"), F.col("rating").alias("value"))
    return sio.roundtrip_parquet(im, "sparse")


@register(
    "cluster_assignments_roundtrip",
    f"{V('item_clusters')} SELECT movieId, cluster FROM item_clusters",
)
def cluster_assignments_roundtrip(spark, sf_dir):
    """Cluster map written as CSV with an explicit schema and read back."""
    return sio.roundtrip_csv(fx.item_clusters(spark, sf_dir), "clusters", "movieId bigint, cluster int")



# ------------------------------------------------------- segment building blocks
_POS_SQL = "pos AS (SELECT userId, movieId, rating FROM ratings WHERE rating > 3.5)"


@register(
    "user_genre_counts",
    f"""{V('ratings', 'movies')}, {_POS_SQL}
SELECT p.userId, g.genre, count(*) AS n FROM pos p
JOIN (SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM movies) g ON p.movieId = g.movieId GROUP BY p.userId, g.genre""",
)
def user_genre_counts(spark, sf_dir):
    """A4: positive ratings per (user, genre)."""
    j = R.positive_with_genres(fx.positive_ratings(spark, sf_dir, POSITIVE), fx.movies(spark, sf_dir), POSITIVE)
    return j.groupBy("userId", "genre").agg(F.count(F.lit(1)).alias("n"))


@register(
    "user_genre_share",
    f"""{V('ratings', 'movies')}, {_POS_SQL},
gc AS (SELECT p.userId, g.genre, count(*) AS n FROM pos p
       JOIN (SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM movies) g ON p.movieId = g.movieId GROUP BY p.userId, g.genre)
SELECT userId, genre, n / sum(n) OVER (PARTITION BY userId) AS share FROM gc""",
)
def user_genre_share(spark, sf_dir):
    """A5: row-normalised genre shares (window sum per user)."""
    c = user_genre_counts(spark, sf_dir)
    return c.select("userId", "genre", (F.col("n") / F.sum("n").over(Window.partitionBy("userId"))).alias("share"))


@register(
    "user_cluster_mean",
    f"""{V('ratings', 'item_clusters')}, {_POS_SQL}
SELECT p.userId, c.cluster, avg(p.rating) AS mean_rating FROM pos p JOIN item_clusters c ON p.movieId = c.movieId GROUP BY p.userId, c.cluster""",
)
def user_cluster_mean(spark, sf_dir):
    """Mean positive rating per (user, item cluster)."""
    r = fx.positive_ratings(spark, sf_dir, POSITIVE)
    return r.join(fx.item_clusters(spark, sf_dir), "movieId").groupBy("userId", "cluster").agg(
        F.avg("rating").alias("mean_rating"))


@register(
    "user_density",
    f"{V('ratings')}, {_POS_SQL} SELECT userId, count(*) AS positive_count FROM pos GROUP BY userId",
)
def user_density(spark, sf_dir):
    """Positive ratings per user."""
    return fx.positive_ratings(spark, sf_dir, POSITIVE).groupBy("userId").agg(
        F.count(F.lit(1)).alias("positive_count"))


@register(
    "pivot_scores",
    f"""{V('genome_scores')},
dup AS (SELECT count(*) AS d FROM (SELECT movieId, tagId FROM genome_scores GROUP BY movieId, tagId HAVING count(*) > 1))
SELECT movieId, {', '.join(f"coalesce(max(CASE WHEN tagId = {t} THEN relevance END), CAST(0 AS DOUBLE)) AS tag_{t:02d}" for t in range(64))}
FROM genome_scores GROUP BY movieId""",
)
def pivot_scores(spark, sf_dir):
    """A10: long -> wide (one column per tag, 0-filled) with explicit pivot values from the tag
    dictionary (a bounded dimension); duplicate (movie, tag) cells raise like the reference."""
    gs = fx.genome_scores(spark, sf_dir)
    tags = [r.tagId for r in fx.genome_tags(spark, sf_dir).orderBy("tagId").collect()]  # dictionary, not facts
    wide = gs.groupBy("movieId").pivot("tagId", tags).agg(F.first("relevance").alias("v"), F.count(F.lit(1)).alias("n"))
    twice = F.raise_error(F.lit("duplicate (movieId, tagId) in pivot")).cast("double")
    return wide.select("movieId", *[
        F.when(F.col(f"{t}_n") > 1, twice).otherwise(F.coalesce(F.col(f"{t}_v"), F.lit(0.0))).alias(f"tag_{t:02d}") for t in tags])


@register(
    "topk_scores",
    f"""{V('item_vectors')},
l AS (SELECT id, CAST(unnest(range(len(vec))) AS INTEGER) AS pos, unnest(vec) AS x FROM item_vectors),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY x DESC, pos) AS INTEGER) AS rank FROM l)
SELECT id, pos, x AS score, rank FROM r WHERE rank <= 3""",
)
def topk_scores(spark, sf_dir):
    """Arg-sort top-k positions of a score vector (posexplode, then per-row top-k)."""
    l = fx.item_vectors(spark, sf_dir).select("id", F.posexplode("vec").alias("pos", "score"))
    return Rel.top_k_per_group(l, ["id"], [F.col("score").desc(), F.col("pos").asc()], 3)


@register(
    "genres_join",
    f"{V('movies')} SELECT movieId, array_to_string(list_sort(list_distinct(string_split(genres, '|'))), '|') AS genres_key FROM movies",
)
def genres_join(spark, sf_dir):
    """F8: genre list joined back with '|' (sorted distinct tokens as a canonical key)."""
    return fx.movies(spark, sf_dir).select(
        "movieId", F.concat_ws("|", F.array_sort(F.array_distinct(C.genre_tokens("genres")))).alias("genres_key"))
