"""The registered queries of this subpackage, and their DuckDB SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import kneser_ney, oracles
from marquee.llm.centroids import cluster
from marquee.llm.common import table, tokenizer_file
from marquee.llm.jaccard_join import JaccardJoin
from marquee.llm.mixing import mix
from marquee.llm.packing import pack, with_digests
from marquee.llm.quality_rules import quality_rules
from marquee.llm.resampling import resample
from marquee.llm.sharding import shard_documents
from marquee.llm.signatures import SignatureJoin
from marquee.llm.style_tree import main_text
from marquee.llm.syncmers import edited_neighbours
from marquee.llm.token_counts import count_tokens
from marquee.llm.warc import round_trip

SHARDS = 40


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digests(pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2048))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op6_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), 4096)


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", "length", "perplexity", "limit", "kept")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return JaccardJoin(table(spark, sf_dir, "documents")).documents()


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SignatureJoin(table(spark, sf_dir, "documents")).documents()


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_text": op1_html_text,
        "op2_packing": op2_packing,
        "op3_sharding": op3_sharding,
        "op4_quality_rules": op4_quality_rules,
        "op5_mixing": op5_mixing,
        "op6_syncmers": op6_syncmers,
        "op7_token_counts": op7_token_counts,
        "op8_kneser_ney": op8_kneser_ney,
        "op9_warc": op9_warc,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_minhash": op11_minhash,
        "op12_centroids": op12_centroids,
        "op13_resampling": op13_resampling,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_quality_rules": oracles.QUALITY_RULES,
        "op5_mixing": oracles.MIXING,
        "op9_warc": oracles.WARC,
        "op12_centroids": oracles.CENTROIDS,
        "op13_resampling": oracles.RESAMPLING,
    }
