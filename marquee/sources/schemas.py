"""Explicit schemas of the reference's input files (no inference on read)."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "bigint"
RATING = "double"

MOVIES = T.StructType(
    [
        T.StructField("movieId", T.LongType(), False),
        T.StructField("title", T.StringType(), True),
        T.StructField("genres", T.StringType(), True),
    ]
)

RATINGS = T.StructType(
    [
        T.StructField("userId", T.LongType(), False),
        T.StructField("movieId", T.LongType(), False),
        T.StructField("rating", T.DoubleType(), True),
        T.StructField("timestamp", T.LongType(), True),
    ]
)

GENOME_SCORES = T.StructType(
    [
        T.StructField("movieId", T.LongType(), False),
        T.StructField("tagId", T.LongType(), False),
        T.StructField("relevance", T.DoubleType(), True),
    ]
)

GENOME_TAGS = T.StructType(
    [T.StructField("tagId", T.LongType(), False), T.StructField("tag", T.StringType(), True)]
)

IMPORTANCE = T.StructType(
    [
        T.StructField("movieId", T.LongType(), False),
        T.StructField("importance_score", T.IntegerType(), False),
        T.StructField("seq", T.IntegerType(), False),
    ]
)

VECTORS = T.StructType(
    [T.StructField("id", T.LongType(), False), T.StructField("vec", T.ArrayType(T.DoubleType()), True)]
)

SPARSE = T.StructType(
    [
        T.StructField("row", T.LongType(), False),
        T.StructField("col", T.LongType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)

CSV_SCHEMAS = {
    "movies": MOVIES,
    "ratings": RATINGS,
    "genome-scores": GENOME_SCORES,
    "genome-tags": GENOME_TAGS,
}
