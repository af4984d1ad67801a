"""Feature matrices.

Wide matrices stay in a stable schema: one array column per block, ordered by a
sorted vocabulary that is computed from the data (one small row, broadcast).
Per-entity maps that feed the arrays are bounded by the vocabulary size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import genre_tokens, hash_bucket, multi_hot
from marquee.operators.relational import popularity, scalar_quantile, with_scalars
from marquee.operators.vectors import dim_stats, round_vec, standard_scale
from marquee.session import cut_lineage

POSITIVE = 3.5


def _dense_from_map(m, vocab):
    return F.transform(vocab, lambda k: F.coalesce(F.try_element_at(m, k), F.lit(0.0)))


def user_segment_matrix(ratings: DataFrame, movies: DataFrame, item_clusters: DataFrame,
                        threshold: float = POSITIVE) -> DataFrame:
    """Per user [genre shares | mean positive rating per item cluster | positive count], 0-filled.

    userId, genre_share array<double> (sorted genres), cluster_rating array<double>
    (sorted cluster ids), positive_count bigint. The facts are counted by (user, genre) and by (user, cluster);
    these two small tables are written, and grouped once by user."""
    pos = ratings.where(F.col("rating") > threshold).select("userId", "movieId", "rating")
    pos = pos.join(movies.select("movieId", genre_tokens("genres").alias("_g")), "movieId", "left")
    pos = pos.join(item_clusters.select("movieId", F.col("cluster").cast("int").alias("cluster")), "movieId", "left").drop("movieId")
    nothing = {k: F.lit(None).cast(t) for k, t in (("genre", "string"), ("cluster", "int"), ("r", "double"))}
    genres = pos.select("userId", F.explode("_g").alias("genre")).groupBy("userId", "genre").agg(F.count(F.lit(1)).alias("n"))
    genres = genres.select("userId", F.lit(True).alias("is_genre"), "genre", nothing["cluster"].alias("cluster"), "n", nothing["r"].alias("r"))
    clusters = pos.groupBy("userId", "cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("r"))  # items without one: null
    clusters = clusters.select("userId", F.lit(False).alias("is_genre"), nothing["genre"].alias("genre"), "cluster", "n", "r")
    cells = cut_lineage(genres.unionByName(clusters))

    def of(key, value):
        return F.collect_list(F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("k"), F.col(value).cast("double").alias("v"))))

    per = cells.groupBy("userId").agg(of("genre", "n").alias("_g"), of("cluster", "r").alias("_c"),
                                      F.sum(F.when(~F.col("is_genre"), F.col("n"))).alias("positive_count"))
    vocab = cells.agg(F.sort_array(F.collect_set("genre")).alias("_gv"), F.sort_array(F.collect_set("cluster")).alias("_cv"))
    total = F.aggregate("_g", F.lit(0.0), lambda acc, e: acc + e["v"])
    shares = F.map_from_entries(F.transform("_g", lambda e: F.struct(e["k"], (e["v"] / F.col("_n")).alias("v"))))
    return with_scalars(per.withColumn("_n", total), vocab).select(
        "userId",
        _dense_from_map(shares, F.col("_gv")).alias("genre_share"),
        _dense_from_map(F.map_from_entries("_c"), F.col("_cv")).alias("cluster_rating"),
        F.col("positive_count").cast("bigint").alias("positive_count"),
    )


def tag_split(tag_ids: DataFrame, test_buckets: int = 2, buckets: int = 10) -> DataFrame:
    """Deterministic 80/20 split of tag columns by md5 bucket."""
    return tag_ids.select("tagId").distinct().withColumn(
        "split", F.when(hash_bucket("tagId", buckets) < test_buckets, "test").otherwise("train"))


def row_split(df: DataFrame, key: str, test_buckets: int = 2, buckets: int = 10) -> DataFrame:
    """Deterministic row split by md5 bucket of the key."""
    return df.withColumn("split", F.when(hash_bucket(key, buckets) < test_buckets, "test").otherwise("train"))


def content_matrix(scores: DataFrame, tags: DataFrame, quantile: float | None = 0.75,
                   split: bool = True) -> DataFrame:
    """(quantile filter) -> movie x tag matrix (0-filled) -> tag names -> split -> min-max per tag.

    Long form: movieId, tagId, tag, split, value — only non-zero cells are stored; a
    0-filled cell scales to (0 - min) / range, which is 0 whenever the tag is missing
    for some movie (min = 0), so the sparse form is exact.
    """
    s = scores
    if quantile is not None:
        s = with_scalars(s, scalar_quantile(s, "relevance", quantile, "_q")).where(F.col("relevance") >= F.col("_q")).drop("_q")
    n_movies = s.agg(F.countDistinct("movieId").alias("_n"))
    per_tag = s.groupBy("tagId").agg(
        F.min("relevance").alias("_mn"), F.max("relevance").alias("_mx"), F.countDistinct("movieId").alias("_k"))
    per_tag = with_scalars(per_tag, n_movies).select(
        "tagId",
        F.when(F.col("_k") < F.col("_n"), F.least(F.col("_mn"), F.lit(0.0))).otherwise(F.col("_mn")).alias("_lo"),
        F.greatest(F.col("_mx"), F.lit(0.0)).alias("_hi"),
    )
    out = s.join(per_tag, "tagId").join(F.broadcast(tags), "tagId")
    rng = F.when(F.col("_hi") - F.col("_lo") == 0, F.lit(1.0)).otherwise(F.col("_hi") - F.col("_lo"))
    out = out.withColumn("value", F.round((F.col("relevance") - F.col("_lo")) / rng, 6))
    if split:
        out = out.join(F.broadcast(tag_split(tags)), "tagId")
    else:
        out = out.withColumn("split", F.lit("all"))
    return out.select("movieId", "tagId", "tag", "split", "value")


def segment_features(movies: DataFrame, ratings: DataFrame, digits: int = 6) -> DataFrame:
    """M3: per movie [mean rating, count, multi-hot genres] standardized (population std).

    Unrated movies get mean 0 and count 0. Returns movieId, features, plus the
    fitted per-dimension stats via ``segment_scaler``.
    """
    raw = segment_raw_features(movies, ratings)
    scaled = standard_scale(raw, "raw", "features")
    return scaled.select("movieId", round_vec("features", digits).alias("features"))


def segment_raw_features(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    pop = popularity(ratings, mean_name="mean_rating", count_name="rating_count")
    df = movies.join(pop, "movieId", "left").na.fill({"mean_rating": 0.0, "rating_count": 0})
    vocab = movies.select(F.explode(genre_tokens("genres")).alias("g")).agg(F.sort_array(F.collect_set("g")).alias("_cls"))
    x = with_scalars(df, vocab)
    feats = F.concat(
        F.array(F.col("mean_rating").cast("double"), F.col("rating_count").cast("double")),
        multi_hot(genre_tokens("genres"), F.col("_cls")),
    )
    return x.select("movieId", "title", "mean_rating", "rating_count", feats.alias("raw"))


def segment_scaler(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    return dim_stats(segment_raw_features(movies, ratings), "raw")
