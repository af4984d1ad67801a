"""Closed-syncmer fingerprints of documents (operator 6).

A window of ``K`` code points is an anchor if the smallest of its inner substrings of ``S`` code
points (by hash) is the first or the last one. That depends on the window alone, so an edit moves no
anchor outside it, and any ``K - S + 1`` successive windows hold at least one. A fingerprint is the
24-bit hashes of the distinct anchors in order of first occurrence, in base 64 (4 characters each).
Two fingerprints are compared by position: the longest run of common anchors that stands in the same
order in both, twice over the sum of their sizes.

A text with fewer than ``FEW`` anchors also has those of a finer scale (``FINE``: inner substrings and
windows of 4 and 11 code points), after a dot. Two texts that both have them are compared by them, any
others by the common scale.

Defined cases: equal texts have equal fingerprints and likeness 1; two empty ones too. An empty or
null text has an empty fingerprint, which is like no other (0). A text shorter than ``K`` (or the
finer scale's windows) has one anchor there, the hash of all of it. Texts that repeat a period have as many anchors as it has.

``edited_neighbours`` compares each document with its edited text and with the next document. It cuts
the ids into ranges of about ``RANGE_BYTES`` of text and sends each row to its range once; the first
document of each range is sent to the range before it too, so the next document is always the next
row of the task's sorted stream. Rows with equal ids are ordered by text; null ids come last. A
single document is followed by itself. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.words import mix

S, WINDOW = 8, 32
K = WINDOW + S - 1
#: The finer scale (S, WINDOW), and the anchors from which a text needs none.
FINE, FEW = (4, 8), 16
RANGE_BYTES = 8 << 20

_STEP, _MASK = 0x9E3779B97F4A7C55, (1 << 64) - 1


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Anchors(np.ndarray):
    """Anchors of a text, with those of the finer scale as ``fine`` if there are few."""

    fine: np.ndarray | None = None


def _scale(points: np.ndarray, inner: int, window: int) -> np.ndarray:
    x = mix(points.astype(np.uint64) + np.uint64(1))
    if len(points) < window + inner - 1:
        whole = 0
        for v in x.tolist():
            whole = (whole * _STEP + v) & _MASK
        return (mix(np.array([whole], np.uint64)) >> np.uint64(40)).astype(np.uint32)
    step, size = _STEP, 1
    while size < inner:
        x = x[:-size] * np.uint64(step) + x[size:]
        step, size = step * step & _MASK, 2 * size
    order = mix(x)
    least, size = order, 1
    while size < window:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    at = np.flatnonzero((order[: len(least)] == least) | (order[window - 1 :] == least))
    key = x[at + (window - 1)]
    for back in range(0, window - 1, inner):  # all code points of the window
        key = key * np.uint64(_STEP) + x[at + back]
    key = (mix(key) >> np.uint64(40)).astype(np.uint32)
    _, first = np.unique(key, return_index=True)
    return key[np.sort(first)]


def anchors(points: np.ndarray) -> Anchors:
    """24-bit hashes of the distinct anchors, in order of first occurrence."""
    if not len(points):
        return np.zeros(0, np.uint32).view(Anchors)
    found = _scale(points, S, WINDOW).view(Anchors)
    if len(found) < FEW:
        found.fine = _scale(points, *FINE)
    return found


def _base64(found: np.ndarray) -> str:
    return base64.b64encode(found.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes()).decode()


def fingerprint(found: np.ndarray) -> str:
    fine = getattr(found, "fine", None)
    return _base64(found) if fine is None else f"{_base64(found)}.{_base64(fine)}"


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the longest common run in order, over the sum of sizes, at the finest scale of both."""
    if getattr(a, "fine", None) is not None and getattr(b, "fine", None) is not None:
        a, b = a.fine, b.fine
    if len(a) == len(b) and np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    place = {v: i for i, v in enumerate(b.tolist())}
    tails: list[int] = []
    for v in a.tolist():
        i = place.get(v)
        if i is None:
            continue
        if not tails or i > tails[-1]:
            tails.append(i)
        else:
            tails[bisect_left(tails, i)] = i
    return 2 * len(tails) / (len(a) + len(b))


class _Row:
    __slots__ = ("doc_id", "range", "text", "points", "anchors", "print")

    def __init__(self, doc_id, range_, text: str):
        self.doc_id, self.range, self.text, self.points = doc_id, range_, text, code_points(text)
        self.anchors = anchors(self.points)
        self.print = fingerprint(self.anchors)

    def against(self, following: _Row) -> tuple:
        n = len(self.points)
        edited = self.text[: n - n // 3] + following.text[: n // 3]
        found = anchors(np.concatenate([self.points[: n - n // 3], following.points[: n // 3]]))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        return self.doc_id, n, digest, self.print, fingerprint(found), likeness(self.anchors, found), likeness(self.anchors, following.anchors)


_COLUMNS = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: _Row | None = None
    for batch in batches:
        ids, out = batch["doc_id"], []
        for doc_id, range_, guest, text in zip(ids.to_pylist(), batch["range"].to_pylist(), batch["guest"].to_pylist(), batch["text"]):
            if guest and last is None:
                continue  # a further row with the id of the first guest
            row = _Row(doc_id, range_, text.as_py())
            if last is not None:
                out.append(last.against(row))
            last = None if guest else row
        columns = list(zip(*out)) or [()] * 7
        arrays = [pa.array(columns[0], ids.type), *(pa.array(c, kind) for c, (_, kind) in zip(columns[1:], _COLUMNS))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *(name for name, _ in _COLUMNS)])


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every document."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(-(1 << 63))).cast("long").alias("key"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    count = min(math.ceil(size / RANGE_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = []
    if count > 1:
        shares = [i / count for i in range(1, count)]
        cuts = sorted({float(c) for c in rows.agg(F.percentile_approx("key", shares, 20 * count)).first()[0]})
    splits = Bucketizer(splits=[-math.inf, *cuts, math.inf] if cuts else [-math.inf, 0.0, math.inf], inputCol="as_double", outputCol="range")
    ranged = splits.transform(rows.withColumn("as_double", F.col("key").cast("double"))).drop("as_double")

    # one row a range: its first document in descending order also goes to the range above, that of the top range to the lowest
    heads = ranged.groupBy("range").agg(F.max("key").alias("key"))
    every = Window.orderBy("range")
    ends = F.first("range").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("key", F.coalesce(F.lead("range").over(every), ends).alias("also"))
    places = F.array_compact(F.array(F.struct("range", F.lit(False).alias("guest")), F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("range"), F.lit(True).alias("guest")))))
    sent = ranged.join(F.broadcast(heads), "key", "left").select("doc_id", "text", "key", F.explode(places).alias("p")).select("doc_id", "text", "key", "p.*")
    dealt = sent.repartition(max(count, 1), "range").sortWithinPartitions("range", "guest", F.desc("key"), "text")
    schema = docs.select("doc_id").schema
    for name, kind in (("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")):
        schema = schema.add(name, kind)
    return dealt.select("doc_id", "range", "guest", "text").mapInArrow(_compared, schema)
