"""Structured Streaming extension: incremental popularity (A1) over arriving ratings.

Order lines arrive as parquet files; each is joined to the static orders table
(stream-static join) to form ratings, and a stateful streaming aggregation keeps
sum and count per movie in the state store (checkpointed under the shared
``spark.checkpoint.dir``). The query runs in update mode: a micro-batch brings only
the movies it has changed, which replace their rows of the folder before it. Folders
are named by batch id, so a replayed batch overwrites the same folder (idempotent
sink), and readers open the newest folder only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.fixtures import rating_expr, table
from marquee.sources.io import shared_path


def ratings_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """Streaming ratings: lineitem files as they arrive, joined to the static orders."""
    li_schema = table(spark, sf_dir, "lineitem").schema
    lines = (spark.readStream.schema(li_schema).option("maxFilesPerTrigger", files_per_trigger)
             .option("pathGlobFilter", "lineitem*.parquet").parquet(sf_dir.rstrip("/")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"),
        rating_expr(F.col("l_quantity")).alias("rating"))


def run_popularity_stream(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
                          checkpoint: str | None = None) -> str:
    """Run the stream until the available input is consumed; returns the sink folder."""
    out_dir = out_dir or shared_path(spark, "popularity-stream")
    checkpoint = checkpoint or shared_path(spark, "popularity-stream-ckpt")
    agg = ratings_stream(spark, sf_dir).groupBy("movieId").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_count"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        current = batch.select("movieId", "rating_sum", "rating_count")
        if batch_id:
            before = batch.sparkSession.read.schema(current.schema).parquet(_folder(out_dir, batch_id - 1))
            current = before.join(current, "movieId", "left_anti").unionByName(current)
        current.write.mode("overwrite").parquet(_folder(out_dir, batch_id))

    q = (agg.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out_dir


def _folder(out_dir: str, batch_id: int) -> str:
    return f"{out_dir}/batch={batch_id:012d}"


def latest_popularity(spark: SparkSession, out_dir: str) -> DataFrame:
    """Newest batch of the sink as (movieId, ave_rating, rating_count); file names tell which it is."""
    newest = max(int(re.search(r"/batch=(\d+)/", f)[1]) for f in spark.read.parquet(out_dir).inputFiles())
    cur = spark.read.parquet(_folder(out_dir, newest))
    return cur.select("movieId", (F.col("rating_sum") / F.col("rating_count")).alias("ave_rating"), "rating_count")
