"""Adapters from the driver's TPC-H-style tables to the recommendation data model.

Each adapter returns a lazy DataFrame keyed by natural ids; nothing is collected.
``VIEW_SQL`` holds the same definitions as DuckDB SQL so oracle queries can be
stated over the raw parquet views (region ... conversations).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.schemas import ID, RATING

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values for the oracle-checkable fixtures (FIXTURES.md §2).
PROMOTED_IDS = (1, 50, 300)
BLOCK_MODULUS = 7
SEED_IDS = (1, 10, 100)
APP_GENRES = ("small", "ring")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rating_expr(quantity: Column) -> Column:
    # both operands cast: `/2.0` would make a decimal in Spark
    return F.ceil(quantity / F.lit(5)).cast("double") / F.lit(2).cast("double")


def ratings(spark: SparkSession, sf_dir: str, quantity_above: float | None = None) -> DataFrame:
    """userId, movieId, rating (0.5..5.0 half steps), timestamp (epoch seconds)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    if quantity_above is not None:
        li = li.where(F.col("l_quantity") > F.lit(float(quantity_above)))
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").cast(ID).alias("userId"),
        F.col("l_partkey").cast(ID).alias("movieId"),
        rating_expr(F.col("l_quantity")).cast(RATING).alias("rating"),
        F.unix_timestamp("o_orderdate").alias("timestamp"),
    )


def positive_ratings(spark: SparkSession, sf_dir: str, threshold: float = 3.5) -> DataFrame:
    """Ratings above ``threshold``, with the equivalent predicate on the stored column so that it
    reaches the parquet scan (a filter on the derived rating alone cannot be pushed down):
    ceil(q/5)/2 > t  <=>  ceil(q/5) > floor(2t)  <=>  q > 5 * floor(2t)."""
    return ratings(spark, sf_dir, 5.0 * math.floor(2 * threshold)).where(F.col("rating") > threshold)


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movieId, title, genres ('a|b|TYPE')."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast(ID).alias("movieId"),
        F.col("p_name").alias("title"),
        F.concat(F.regexp_replace("p_name", " ", "|"), F.lit("|"), F.col("p_type")).alias("genres"),
    )


def genome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movieId, tagId, relevance in [0, 1] (long form of the embedding table)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "x"))
    return e.select(
        F.col("vec_id").cast(ID).alias("movieId"),
        F.col("pos").cast(ID).alias("tagId"),
        ((F.col("x").cast("double") + F.lit(1)) / F.lit(2)).alias("relevance"),
    )


def genome_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tagId, tag: the tag dictionary derived from the tag positions present."""
    return (
        genome_scores(spark, sf_dir)
        .select("tagId")
        .distinct()
        .select("tagId", F.format_string("tag_%02d", F.col("tagId")).alias("tag"))
    )


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast(ID).alias("id"),
        F.col("embedding").cast("array<double>").alias("vec"),
        F.col("label").alias("cluster"),
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id (= movieId), vec array<double>, cluster (given label)."""
    return _vectors(spark, sf_dir)


def user_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id (= userId), vec array<double>, cluster (given label)."""
    return _vectors(spark, sf_dir)


def item_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast(ID).alias("movieId"), (F.col("p_size") % 10).alias("cluster")
    )


def user_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast(ID).alias("user_id"), F.col("c_nationkey").alias("cluster")
    )


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promote/block flags in write order: promoted literals (seq 1), blocked ids (seq 2)."""
    promo = spark.createDataFrame([(i,) for i in PROMOTED_IDS], f"movieId {ID}").select(
        "movieId", F.lit(1).alias("importance_score"), F.lit(1).alias("seq")
    )
    block = (
        table(spark, sf_dir, "embeddings")
        .where(F.col("vec_id") % BLOCK_MODULUS == 0)
        .select(F.col("vec_id").cast(ID).alias("movieId"), F.lit(-1).alias("importance_score"), F.lit(2).alias("seq"))
    )
    return promo.unionByName(block)


def seed_requests(spark: SparkSession, seeds=SEED_IDS, request_id: int = 1) -> DataFrame:
    """Request table (request_id, movieId) for the app's watched-ids input."""
    return spark.createDataFrame([(request_id, int(s)) for s in seeds], f"request_id {ID}, movieId {ID}")


# ---------------------------------------------------------------------------
# DuckDB definitions of the same views (used by oracle SQL).
VIEW_SQL: dict[str, str] = {
    "ratings": (
        "SELECT o.o_custkey AS userId, l.l_partkey AS movieId, "
        "CAST(ceil(l.l_quantity / 5) AS DOUBLE) / CAST(2 AS DOUBLE) AS rating, "
        "CAST(epoch(o.o_orderdate) AS BIGINT) AS \"timestamp\" "
        "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"
    ),
    "movies": (
        "SELECT p_partkey AS movieId, p_name AS title, "
        "replace(p_name, ' ', '|') || '|' || p_type AS genres FROM part"
    ),
    "genome_scores": (
        "SELECT movieId, tagId, (CAST(x AS DOUBLE) + 1) / 2 AS relevance FROM ("
        "SELECT vec_id AS movieId, CAST(unnest(range(len(embedding))) AS BIGINT) AS tagId, "
        "unnest(embedding) AS x FROM embeddings)"
    ),
    "genome_tags": "SELECT DISTINCT tagId, printf('tag_%02d', tagId) AS tag FROM genome_scores",
    "item_vectors": "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label AS cluster FROM embeddings",
    "user_vectors": "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label AS cluster FROM embeddings",
    "item_clusters": "SELECT p_partkey AS movieId, p_size % 10 AS cluster FROM part",
    "user_clusters": "SELECT c_custkey AS user_id, c_nationkey AS cluster FROM customer",
    "importance": (
        "SELECT CAST(movieId AS BIGINT) AS movieId, 1 AS importance_score, 1 AS seq "
        f"FROM (VALUES {', '.join(f'({i})' for i in PROMOTED_IDS)}) t(movieId) "
        f"UNION ALL SELECT vec_id, -1, 2 FROM embeddings WHERE vec_id % {BLOCK_MODULUS} = 0"
    ),
    "seeds": (
        "SELECT CAST(1 AS BIGINT) AS request_id, CAST(movieId AS BIGINT) AS movieId "
        f"FROM (VALUES {', '.join(f'({i})' for i in SEED_IDS)}) t(movieId)"
    ),
}

# view -> views it reads (so a query pulls in only what it needs, in order)
_VIEW_DEPS = {"genome_tags": ["genome_scores"]}


def with_views(*names: str) -> str:
    """``WITH`` prefix defining the named derived views (and their dependencies)."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in _VIEW_DEPS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in ordered)
