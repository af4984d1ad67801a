"""Target-distribution importance resampling by hashed n-grams (operator 13).

A 256-byte table lower-cases A-Z and blanks every ASCII character that is no letter or digit; bytes
from 0x80 on, so whole UTF-8 sequences, stay. ``bytes.split`` then gives the words. The features of a
text are its runs of 1 to ``n`` words, joined by one space; the CRC of a run is that of the run
without its last word, carried on over a space and that word. Features fall into ``buckets``.

* Each task adds up one Counter of buckets over all its texts, so at most ``buckets`` rows a task are
  shuffled. From the sums in the documents and in the target, a bucket gets its gain in thousandths.
* The gains (one number a bucket, so bounded by the parameter) go to the tasks, which add them up
  over the features of each text: its weight.
* Gumbel noise from a hash of the id turns the highest scores into a draw without replacement.
  Ranks come from a range-partitioned running count: no task holds all rows.

Defined cases: a null or empty text has no words, no features and the weight 0. A null id is hashed
as an empty one. Rows with equal ids share their noise; rows with equal scores and ids have ranks
of their own, in any order. An empty target leaves gains by its smoothing alone, an empty table
gives no rows. Texts are read whole. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written
from marquee.llm.words import text_slices
from marquee.operators.relational import running_total

#: Letters and digits stay, A-Z in lower case, and so does all that is not ASCII.
TABLE = bytes(b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TABLE).split()


def features(found: list[bytes], n: int, buckets: int) -> Counter:
    """How many runs of 1 to n consecutive words fall into each bucket."""
    out: Counter = Counter()
    for word, times in Counter(found).items():
        out[crc32(word) % buckets] += times
    ends = [crc32(word) for word in found] if n > 1 else []
    for k in range(1, n):
        ends = [crc32(word, crc32(b" ", end)) for end, word in zip(ends, found[k:])]
        out.update(end % buckets for end in ends)
    return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in text_slices(batches, "text"):
        yield batch, batch["text"].to_pylist()


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """(bucket, n) over all rows of ``texts`` (text among others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for _, column in _texts(batches):
            for text in column:
                total.update(features(words(text), n, buckets))
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int64()), pa.array(total.values(), pa.int64())], names=["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, n: int, buckets: int) -> DataFrame:
    """(bucket, gain): thousandths of the log of how much likelier the bucket is in the target; written."""
    rows = written(bucket_counts(docs, n, buckets), "source-counts").join(
        written(bucket_counts(target, n, buckets), "target-counts").withColumnRenamed("n", "t"), "bucket", "full"
    )  # at most one row a bucket on both sides
    rows = rows.select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(a) for c, a in (("n", "s"), ("t", "t"))])
    sums = F.broadcast(rows.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(f"all_{c}") for c in "st"]))  # one row
    rise = F.log((F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets)))
    return written(rows.join(sums).select("bucket", F.floor(1000 * rise).alias("gain")), "gains")


def weighed(docs: DataFrame, found: DataFrame, n: int, buckets: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document, by the gains ``found``."""
    table = [0] * buckets
    for row in found.collect():  # one number a bucket
        table[row["bucket"]] = row["gain"]
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch, column in _texts(batches):
            sizes, totals, weights = [], [], []
            for text in column:
                seen = words(text)
                each = features(seen, n, buckets)
                sizes.append(len(seen))
                totals.append(each.total())
                weights.append(sum(gain[b] * times for b, times in each.items()))
            columns = [batch["doc_id"], *(pa.array(x, pa.int64()) for x in (sizes, totals, weights))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    schema = docs.select("doc_id").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def noise(seed: str) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of the id."""
    named = F.sha2(F.concat_ws("", F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(named, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: str = "2024") -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; the rank is null where it isn't drawn.

    ``percent`` of the documents with ``least_words`` words are drawn, rounded down.
    """
    found = gains(docs, target, n, buckets)
    scored = weighed(docs, found, n, buckets).withColumn("score", F.col("weight") + noise(seed))
    scored = written(scored.withColumn("out", (F.col("n_words") < least_words).cast("int")), "scores")
    drawn = F.broadcast(scored.where("out = 0").agg(F.expr(f"count(*) * {percent} div 100").alias("drawn")))  # one row
    spread = scored.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))  # equal rows needn't lie together
    ranked = running_total(spread, [F.col("out").asc(), F.col("score").desc(), F.col("doc_id").asc(), F.col("salt").asc()], None, "place")
    rank = F.when((F.col("out") == 0) & (F.col("place") <= F.col("drawn")), F.col("place").cast("long"))
    return ranked.join(drawn).select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
