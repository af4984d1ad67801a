"""From raw documents to packed sequences: five stages, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before has kept. All
but the last return the columns of documents; columns beyond those that a stage reads are carried
along untouched, whatever their names. Null and empty texts and empty tables are defined by the
operators: a null text is no document of quality (the first stage drops it).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import jaccard_join, kneser_ney, mixing, packing, quality_rules
from marquee.llm.common import table, tokenizer_file, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fences of their language and source."""
    return quality_rules.filter_documents(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within the limit of their language."""
    return kneser_ney.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, the one with the smallest id."""
    return jaccard_join.keep_first(docs, n=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once a pass of its source, in the order of the mixture."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, in the order of the documents read."""
    return packing.with_digests(packing.pack(docs, tokenizer_file("word_bpe_49k.json"), 2048))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("quality classifier", classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mixture),
    ("packing", packed),
]

#: The classifier's model and the tokenizer have no statement in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
