"""Readers and writers (S1-S13): CSV with explicit schemas, parquet tables,
dense <-> long vector layouts, metric tables as JSON, model save/load.

Intermediate tables go to the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import ensure_checkpoint_dir
from marquee.sources.schemas import CSV_SCHEMAS


def read_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Reference CSV inputs with an explicit schema (no inference)."""
    return spark.read.schema(CSV_SCHEMAS[kind]).option("header", True).csv(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: list[str] | None = None, one_file: bool = False) -> str:
    """Distributed write; returns the path. With ``one_file`` a task writes one file, whatever the session's limit."""
    path = shared_path(df.sparkSession, name)
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if one_file:
        w = w.option("maxRecordsPerFile", 0)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def roundtrip_parquet(df: DataFrame, name: str) -> DataFrame:
    """Write and re-read: also cuts the lineage at a reliable, shared location."""
    path = write_table(df, name)
    return df.sparkSession.read.parquet(path)


def roundtrip_csv(df: DataFrame, name: str, schema: str) -> DataFrame:
    path = write_table(df, name, "csv")
    return df.sparkSession.read.schema(schema).option("header", True).csv(path)


def write_metrics_json(df: DataFrame, name: str) -> str:
    """Metric tables as JSON lines."""
    return write_table(df.coalesce(1), name, "json")


def dense_to_long(df: DataFrame, id_col: str, vec_col: str, row: str = "row", col: str = "col",
                  value: str = "value") -> DataFrame:
    """(id, array) -> (row, col, value) by posexplode."""
    return df.select(F.col(id_col).alias(row), F.posexplode(vec_col).alias("_p", value)).select(
        row, F.col("_p").cast("bigint").alias(col), value)


def long_to_dense(df: DataFrame, row: str, col: str, value: str, vec_name: str = "vec",
                  columns: DataFrame | None = None) -> DataFrame:
    """S7 inverse: one slot for every column of the dictionary ``columns`` (default: those that occur), in
    column order, 0 where a row has no cell. A row with two cells of one column is refused.

    The dictionary is one broadcast row, bounded by the number of columns, as is each result row."""
    names = (df if columns is None else columns).select(col).distinct()
    slots = names.agg(F.sort_array(F.collect_set(col)).alias("_slots"))
    cells = df.groupBy(row).agg(F.collect_list(F.struct(F.col(col).alias("k"), F.col(value).cast("double").alias("v"))).alias("_kv"))
    x = cells.crossJoin(F.broadcast(slots))
    filled = F.map_from_entries("_kv")  # raises on a repeated column
    return x.select(row, F.transform("_slots", lambda c: F.coalesce(F.try_element_at(filled, c), F.lit(0.0))).alias(vec_name))


def save_model(model, name: str, spark: SparkSession) -> str:
    """Spark ML model persistence to the shared folder."""
    path = shared_path(spark, name)
    model.write().overwrite().save(path)
    return path
