"""Reading the given tables, and writing intermediate tables to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marquee.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; every executor and the driver see it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


#: Rows of text that a task exchanges with Python at a time, while a table is written.
BATCH_ROWS = 500


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, then read.

    This cuts the lineage in storage that outlives executors. Spark also knows the size of
    the files, so a later join is broadcast only where the table is below
    ``spark.sql.autoBroadcastJoinThreshold``, and shuffled otherwise.
    """
    path, conf, key = shared_folder(df.sparkSession, label), df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a ``written`` table once all that was made from it is written too."""
    jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def tokenizer_file(name: str) -> str:
    """Where an installed vocabulary file lies; such files are never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)
