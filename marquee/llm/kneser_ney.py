"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model (operator 8).

The model is of ``ORDER`` successive code points, with marks for the start and the end of a text.
Trusted documents are those labelled as good and not toxic. One of ``FOLDS`` is held out for the
limits; the model is fitted on all the others. Everything else covers all documents.

Counts, continuation counts, discounts and the probabilities of each order are joins and groupings
of count tables. The result is one table: for each n-gram its interpolated probability, and as a
context its back-off weight. Documents that lie together are packed into blocks of ``BLOCK_BYTES`` of
text, compressed, with the distinct n-grams of the block, and shuffled once. The n-grams are joined
with the table, so both sides are sharded by n-gram, and what is found goes back to the block, whose
documents are scored there. No task holds the model.

A document is kept while its mean negative log-probability is within the limit of its language and
length: the ``QUANTILE`` of the held-out trusted documents of both, plus ``REACH`` times its distance
from their median (at least ``SPREAD``). Lengths are classed by octaves, as means of short texts
scatter more. A class with fewer than ``SUPPORT`` documents in its language has the limit of the class
in all languages, counted from the median of each; classes with fewer are joined there, from the
shortest on, until they have as many. Quantiles are read from counts in bins of ``BIN``, which merge
by adding.

Defined cases: a null or empty text is only the mark of the end; a longer text than a block is one. A null lang is a group of its own,
as ''. A language with fewer than ``SUPPORT`` held-out documents has the median of all of them. If all
are fewer too, every language and length has the limit of all trusted ones; without any trusted document every document is kept. Repeated rows are scored each. Other columns are not read, or are carried untouched by ``filter_documents``.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from marquee.llm.common import written
from marquee.llm.signatures import _held, key_filter
from marquee.llm.words import mix, text_bytes, text_slices

ORDER = 4
FOLDS, QUANTILE, REACH, SPREAD, SUPPORT, BIN = 5, 0.95, 2.0, 0.1, 50, 0.005
#: Octaves of lengths.
CLASSES = 32
BLOCK_BYTES = 32 << 20
START, END = 0x110000, 0x110001
#: Largest table of pairs of bigrams that is addressed directly.
DIRECT = 1 << 24


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows with their marks, and the n+1 offsets of rows."""
    data, offsets = text_bytes(column)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    ends = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    sizes = np.diff(ends)
    bounds = ends + ORDER * np.arange(len(ends))
    out = np.full(bounds[-1], START, np.uint32)
    out[np.arange(len(points)) + np.repeat(bounds[:-1] + ORDER - 1 - ends[:-1], sizes)] = points
    out[bounds[1:] - 1] = END
    return out, bounds


class Grams:
    """The n-grams of a slice of texts: ``code`` of each (-1 across texts), and ``distinct`` as code points."""

    def __init__(self, column: pa.Array):
        points, self.bounds = _points(column)
        last = len(points) - ORDER + 1
        self.sizes = np.diff(self.bounds) - ORDER + 1
        inside = np.zeros(max(last, 0), bool)
        inside[np.arange(self.sizes.sum()) + np.repeat(self.bounds[:-1] - (np.cumsum(self.sizes) - self.sizes), self.sizes)] = True
        self.at = np.flatnonzero(inside)
        seen = np.zeros(END + 1, np.int64)
        seen[points] = 1
        letters = int(seen.sum())
        letter = (np.cumsum(seen) - 1)[points]
        pair = letter[:-1] * letters + letter[1:]
        if letters * letters <= DIRECT:
            known = np.zeros(letters * letters, np.int64)
            known[pair] = 1
            pairs = int(known.sum())
            pair = (np.cumsum(known) - 1)[pair]
        else:
            found, pair = np.unique(pair, return_inverse=True)
            pairs = len(found)
        code = (pair[: last if last > 0 else 0] * pairs + pair[2 : last + 2])[self.at]
        if pairs * pairs <= DIRECT:
            first = np.full(pairs * pairs, -1, np.int64)
            first[code[::-1]] = self.at[::-1]
            used = np.flatnonzero(first >= 0)
            place = np.zeros(pairs * pairs, np.int64)
            place[used] = np.arange(len(used))
            self.code, first = place[code], first[used]
        else:
            _, index, self.code = np.unique(code, return_index=True, return_inverse=True)
            first = self.at[index]
        self.distinct = points[first[:, None] + np.arange(ORDER)]

    def row_sums(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text of a value for every distinct n-gram."""
        sums = np.concatenate([[0.0], np.cumsum(values[self.code])])
        ends = np.concatenate([[0], np.cumsum(self.sizes)])
        return sums[ends[1:]] - sums[ends[:-1]]


def keys(grams: np.ndarray) -> dict[str, np.ndarray]:
    """Hashes that name each n-gram (g4), its context (c4), and those of the orders below it."""

    def key(first: int, after: int) -> np.ndarray:
        out = np.full(len(grams), after - first, np.uint64)
        for i in range(first, after):
            out = mix(out * np.uint64(0x9E3779B97F4A7C55) + grams[:, i].astype(np.uint64) + np.uint64(1))
        return out.view(np.int64)

    out = {}
    for n in range(ORDER, 0, -1):
        out[f"g{n}"] = key(ORDER - n, ORDER)
        if n > 1:
            out[f"c{n}"] = key(ORDER - n, ORDER - 1)
    return out


_KEYS = [k for n in range(ORDER, 0, -1) for k in ([f"g{n}", f"c{n}"] if n > 1 else [f"g{n}"])]


def _counted(texts: DataFrame) -> DataFrame:
    """All keys of each n-gram of the texts, and its count n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            grams = Grams(batch["text"])
            named = keys(grams.distinct)
            counts = np.bincount(grams.code, minlength=len(grams.distinct))
            yield pa.RecordBatch.from_arrays([*(pa.array(named[k]) for k in _KEYS), pa.array(counts.astype(np.int64))], names=[*_KEYS, "n"])

    schema = ", ".join(f"{k} long" for k in _KEYS) + ", n long"
    grams = texts.select("text").mapInArrow(run, schema).groupBy(_KEYS[0])
    return grams.agg(F.sum("n").alias("n"), *[F.first(k).alias(k) for k in _KEYS[1:]])


def _discounts(table: DataFrame) -> list[float]:
    """Discounts for counts of 1, 2 and 3 or more, from the numbers of n-grams that occur 1 to 4 times."""
    n1, n2, n3, n4 = table.agg(*[F.coalesce(F.sum(F.when(F.col("n") == i, 1)), F.lit(0)) for i in range(1, 5)]).first()
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    parts = [(1, n1, n2), (2, n2, n3), (3, n3, n4)]
    return [min(max(i - (i + 1) * y * after / here, 0.0), float(i)) if here else 0.5 for i, here, after in parts]


class Model:
    """``table`` (key, p, weight) of a model fitted on ``texts``, and ``unknown``, the probability of a new code point."""

    def __init__(self, texts: DataFrame):
        tables = {ORDER: written(_counted(texts), "grams")}
        for n in range(ORDER - 1, 0, -1):  # continuation counts
            lower = [k for k in _KEYS if int(k[1]) <= n and k != f"g{n}"]
            more = tables[n + 1].groupBy(f"g{n}").agg(F.count("*").alias("n"), *[F.first(k).alias(k) for k in lower])
            tables[n] = written(more, "grams")
        kinds, total = tables[1].agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        parts, below = [], None
        self.unknown = 1.0 / (kinds + 1)
        for n in range(1, ORDER + 1):
            table, d = tables[n], _discounts(tables[n])
            cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
            if n == 1:
                weight = (table.agg(F.sum(F.least(cut, F.col("n")))).first()[0] or 0.0) / total if total else 1.0
                self.unknown *= weight
                p = F.greatest(F.col("n") - cut, F.lit(0.0)) / F.lit(float(total or 1)) + F.lit(self.unknown)
                below = written(table.select(F.col("g1").alias("key"), p.alias("p")), "order")
            else:
                contexts = written(table.groupBy(f"c{n}").agg(F.sum("n").alias("all"), (F.sum(F.least(cut, F.col("n"))) / F.sum("n")).alias("weight")), "contexts")
                joined = table.select(F.col(f"g{n}").alias("key"), f"c{n}", F.col(f"g{n - 1}").alias("lower"), "n").join(contexts, f"c{n}")
                joined = joined.join(below.select(F.col("key").alias("lower"), F.col("p").alias("p_lower")), "lower")
                p = F.greatest(F.col("n") - cut, F.lit(0.0)) / F.col("all") + F.col("weight") * F.col("p_lower")
                parts.append(contexts.select(F.col(f"c{n}").alias("key"), F.lit(None).cast("double").alias("p"), "weight"))
                below = written(joined.select("key", p.alias("p")), "order")
            parts.append(below.select("key", "p", F.lit(None).cast("double").alias("weight")))
        union = parts[0]
        for part in parts[1:]:
            union = union.union(part)
        self.table = written(union.groupBy("key").agg(F.max("p").alias("p"), F.max("weight").alias("weight")), "model")


def _log_probabilities(named: dict[str, np.ndarray], key: np.ndarray, p: np.ndarray, weight: np.ndarray, unknown: float) -> np.ndarray:
    """Log-probabilities of n-grams by their keys; ``key`` is sorted. Missing p and weight are NaN."""

    def look(wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not len(key):
            return np.full(len(wanted), np.nan)
        at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        return np.where(key[at] == wanted, values[at], np.nan)

    out = look(named["g1"], p)
    out = np.where(np.isnan(out), unknown, out)
    for n in range(2, ORDER + 1):
        own, back = look(named[f"g{n}"], p), look(named[f"c{n}"], weight)
        out = np.where(np.isnan(own), np.where(np.isnan(back), 1.0, back) * out, own)
    return np.log(out)


def _packed(batches: list[pa.RecordBatch]) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
        for batch in batches:
            out.write_batch(batch)
    return sink.getvalue()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block: its name, its rows in Arrow's own format, and the keys of its distinct n-grams."""
    part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

    def block() -> pa.RecordBatch:
        found = [np.unique(np.concatenate(list(keys(Grams(b["text"]).distinct).values()))) for b in held]
        every = np.unique(np.concatenate(found))
        lists = pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), pa.array(every))
        return pa.RecordBatch.from_arrays([pa.array([part << 32 | made], pa.int64()), pa.array([_packed(held)], pa.binary()), lists], names=["block", "rows", "keys"])

    for batch in text_slices(batches, "text"):
        here = pc.sum(pc.binary_length(batch["text"])).as_py() or 0
        if held and size + here > BLOCK_BYTES:
            yield block()
            made, held, size = made + 1, [], 0
        held.append(batch)
        size += here
    if held:
        yield block()


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` without text, and length (n-grams) and loss (their negative log-probability), for every row; written."""
    kept = [c for c in docs.columns if c != "text"]
    blocks = docs.mapInArrow(_blocks, "block long, rows binary, keys array<long>").repartition("block")

    def distinct(rows: pa.Table) -> pa.Table:
        found = pc.list_flatten(rows["keys"])
        return pa.table({"of": pa.array(np.full(len(found), rows["block"][0].as_py()), pa.int64()), "key": found})

    wanted = blocks.groupBy("block").applyInArrow(distinct, "of long, key long")  # both uses read one exchange
    found = wanted.join(model.table, "key").select(F.col("of").alias("block"), "key", "p", "weight")
    result = docs.select(*kept).schema.add("length", "long").add("loss", "double")
    schema, unknown = to_arrow_schema(result), model.unknown

    def score(rows: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found["key"].to_numpy())
        key, p, weight = (found[c].to_numpy()[order] for c in ("key", "p", "weight"))
        out = []
        for packed in rows["rows"].to_pylist():
            for batch in pa.ipc.open_stream(packed):
                grams = Grams(batch["text"])
                loss = -grams.row_sums(_log_probabilities(keys(grams.distinct), key, p, weight, unknown))
                columns = [*(batch[c] for c in kept), pa.array(grams.sizes.astype(np.int64)), pa.array(loss)]
                out.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        return pa.Table.from_batches(out, schema)

    return written(blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, result), "scores")


def _trusted(labels: DataFrame) -> DataFrame:
    """doc_id of all trusted documents, and whether it is held out."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id").distinct()
    return good.withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)) == 0)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of all trusted documents that are not held out."""
    return written(_trusted(labels).where("NOT held").select("doc_id"), "trusted")


def training_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and text of the rows of ``docs`` that the model is fitted on.

    A Bloom filter of the ids, of bounded size, goes to the tasks, so the texts of other rows aren't shuffled
    whatever the number of ids; what it lets through wrongly is joined away.
    """
    ids, key = trusted_ids(labels), F.xxhash64("doc_id").alias("key")
    sent = docs.sparkSession.sparkContext.broadcast(key_filter(ids.select(key)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["doc_id", "text"]).filter(pa.array(_held(sent.value, batch["key"])))

    rows = docs.select("doc_id", "text")
    return rows.select("*", key).mapInArrow(run, rows.schema).join(ids, "doc_id", "left_semi")


def _class() -> Column:
    """The octave of a length."""
    return F.least(F.floor(F.log2("length")), F.lit(CLASSES - 1)).cast("int").alias("class")


def _quantile(bins: np.ndarray, n: np.ndarray, q: float) -> int:
    order = np.argsort(bins)
    return int(bins[order][np.searchsorted(np.cumsum(n[order]), q * n.sum())])


def _limit(bins: np.ndarray, n: np.ndarray) -> float:
    high, middle = (_quantile(bins, n, q) * BIN for q in (QUANTILE, 0.5))
    return high + max(REACH * (high - middle), SPREAD)


def _joined(classes: np.ndarray, n: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Ranges of classes with at least ``least`` documents each, from the shortest on; they cover all classes if there is one."""
    total, out, first, here = np.bincount(classes, n, CLASSES), [], 0, 0
    for c in range(CLASSES):
        here += total[c]
        if here >= least:
            out.append((first, c + 1))
            first, here = c + 1, 0
    if out:
        out[-1] = (out[-1][0], CLASSES)
    return out


def _own(group: pa.Table) -> pa.Table:
    """The median of a language with ``SUPPORT`` documents, and the limits of its classes that have as many."""
    lang, (classes, bins, n) = group["lang"][0], (group[c].to_numpy() for c in ("class", "bin", "n"))
    rows = [(None, _quantile(bins, n, 0.5), None)] if n.sum() >= SUPPORT else []
    for c in np.unique(classes):
        here = classes == c
        if n[here].sum() >= SUPPORT:
            rows.append((int(c), None, _limit(bins[here], n[here])))
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = (pa.int32(), pa.int64(), pa.float64())
    return pa.Table.from_arrays([pa.array([lang.as_py()] * len(rows), pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["lang", "class", "middle", "own"])


def _pooled(group: pa.Table) -> pa.Table:
    """The limit of each class over all languages, from bins that count from the median of each."""
    classes, bins, n = (group[c].to_numpy() for c in ("class", "bin", "n"))
    rows = []
    for first, after in _joined(classes, n, SUPPORT):
        here = (classes >= first) & (classes < after)
        rows += [(c, _limit(bins[here], n[here])) for c in range(first, after)]
    columns = list(zip(*rows)) or [(), ()]
    return pa.Table.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.float64())], names=["class", "excess"])


def _single(group: pa.Table) -> pa.Table:
    """The median and the limit of all documents, whatever their number."""
    bins, n = (group[c].to_numpy() for c in ("bin", "n"))
    return pa.Table.from_arrays([pa.array([n.sum()], pa.int64()), pa.array([_quantile(bins, n, 0.5)], pa.int64()), pa.array([_limit(bins, n)], pa.float64())], names=["all", "every", "rest"])


def limits(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """(lang, class, bound): the largest mean loss of a text of each language and class of lengths, by quantiles of trusted documents."""
    bins = F.floor(F.col("loss") / F.col("length") / BIN).cast("long").alias("bin")
    counts = written(scored.join(_trusted(labels), "doc_id").groupBy("lang", "held", _class(), bins).agg(F.count("*").alias("n")), "bins")
    held = counts.where("held").select("lang", "class", "bin", "n")

    def single(counted: DataFrame) -> DataFrame:
        return counted.groupBy("bin").agg(F.sum("n").alias("n")).groupBy().applyInArrow(_single, "all long, every long, rest double")

    own = written(held.groupBy("lang").applyInArrow(_own, "lang string, class int, middle long, own double"), "own")
    middles = own.where("class IS NULL").select("lang", "middle")
    every = written(single(held).select("every"), "every")  # one row, or none
    centred = held.join(middles, "lang", "left").join(F.broadcast(every)).withColumn("bin", F.col("bin") - F.coalesce("middle", "every"))
    pooled = centred.groupBy("class", "bin").agg(F.sum("n").alias("n")).groupBy().applyInArrow(_pooled, "class int, excess double")
    rest = single(counts).agg(F.coalesce(F.max("rest"), F.lit(math.inf)).alias("rest"))
    found = scored.select("lang", _class()).distinct().join(own.where("class IS NOT NULL").select("lang", "class", "own"), ["lang", "class"], "left").join(middles, "lang", "left")
    found = found.join(pooled, "class", "left").join(F.broadcast(every.agg(F.max("every").alias("every")))).join(F.broadcast(rest))  # one row each
    return written(found.select("lang", "class", F.coalesce("own", F.coalesce("middle", "every") * BIN + F.col("excess"), "rest").alias("bound")), "limits")


def _language():
    return F.coalesce("lang", F.lit("")).alias("lang")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_hash, lang, length, perplexity, limit and kept for every row of ``docs``."""
    rows = docs.select("doc_id", _language(), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    model = Model(training_texts(docs, labels))
    scored = scores(rows, model)
    bounds = limits(scored, labels)
    judged = scored.withColumns({"mean": F.col("loss") / F.col("length"), "class": _class()}).join(bounds, ["lang", "class"], "left")
    return judged.select("doc_id", "text_hash", "lang", "length", F.exp("mean").alias("perplexity"), F.exp("bound").alias("limit"), (F.col("mean") <= F.col("bound")).alias("kept"))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; a row is known by its id and the hash of its text."""
    gone = classify(docs, labels).where("NOT kept").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    gone = written(gone, "rejected")
    same = docs["doc_id"].eqNullSafe(gone["id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["hash"])
    return docs.join(gone, same, "left_anti")
