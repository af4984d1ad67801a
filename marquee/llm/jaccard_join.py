"""N-gram Jaccard join and its components, by a blocked sparse matrix product (operator 10).

Rows of the incidence matrix are documents, columns are word n-grams. Documents with equal rows are
one class. Two classes link when their overlap is at least ``percent`` % of their union, so the
product of the matrix with its transpose is wanted only where it reaches that bound:

* Columns are ordered, rarer ones first. A row of size n can only meet its bound with a row that
  shares one of its first n - ceil(n * percent / 100) + 1 columns, so the product starts on these.
* A pair is dropped if the sizes rule it out, or if the overlap cannot reach the bound with what
  lies behind the shared column in either row. It holds for the first column that a pair shares.
* The columns fall into ``BINS`` bins by hash. A pair cannot overlap by more than the sum over bins of
  its smaller count, so pairs below the bound by this sum are dropped without reading a text.
* For the other pairs overlap counts are added up over all columns, in blocks of pairs.

A column that many rows share is not squared. First each row is paired with one leader a column (the
row with the fewest rarer columns). Of a column whose rows are then still in different components,
the rows outside its largest one are paired with the rows of other components. Every link between
rows of different components is found this way, so components are those of all links.

The order of columns only affects speed. It comes from document counts over blocks of
``COUNT_BLOCK`` n-grams, of which each block passes on those found ``COUNT_LEAST`` times or more;
the ``COMMON`` largest sums are sent to the tasks, and lie last in the order.

Defined cases: words are lower-cased in A-Z only. A text with fewer than n words is one n-gram; an
empty, blank or null text has an empty set, links with nothing and is its own component. Rows with
equal ids are rows of their own, and share a component if they link. N-grams and sets are compared
by 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import discard, written
from marquee.llm.components import components
from marquee.llm.words import set_hashes, shared, shingle_sets, text_slices

COUNT_BLOCK, COUNT_LEAST, COMMON, BINS = 1_000_000, 3, 1 << 18, 64
#: Rows of 8-byte keys that are broadcast at most; larger tables are shuffled.
BROADCAST_ROWS = 1_000_000


def _common_of(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    often = counts >= COUNT_LEAST
    return found[often].view(np.int64), counts[often]


def _few(df: DataFrame) -> DataFrame:
    """Broadcast if the table is proven small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class JaccardJoin:
    """The join of ``docs`` (doc_id, text): ``rows``, and ``labels`` of the classes that have links."""

    def __init__(self, docs: DataFrame, n: int = 3, percent: int = 90):
        self.n, self.percent = n, percent
        self.docs = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))  # together they name a row
        read = self._read()
        self.rows = read.where("n_shingles IS NOT NULL").select("doc_id", "hash", "class", "n_shingles")
        kept = F.min(F.struct("doc_id", "hash")).alias("kept")
        self.classes = written(self.rows.where("n_shingles > 0").groupBy("class").agg(kept, F.min("doc_id").alias("doc_id"), F.count("*").alias("n")), "classes")
        copies = self.rows.join(self.classes.where("n > 1").select("class", "kept"), "class")
        copies = copies.where(~F.struct("doc_id", "hash").eqNullSafe(F.col("kept"))).select(F.col("doc_id").alias("id"), F.col("hash").alias("row_hash"))
        copies = _few(written(copies.distinct(), "copies"))
        self.docs = self.docs.join(copies, self._row(copies), "left_anti")  # one document of each class; the others have equal sets

        common = read.where("n_shingles IS NULL").groupBy("class").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "class").limit(COMMON).collect()
        prefixes = written(self._prefixes([r["class"] for r in reversed(common)]), "prefixes")
        entries = prefixes.select("class", "n", F.posexplode("prefix").alias("place", "column"))
        several = entries.groupBy("column").agg(F.min("class").alias("least"), F.max("class").alias("most")).where("least <> most")
        several = _few(written(several.select("column"), "shared-columns"))
        self.entries = written(entries.join(several, "column", "left_semi").distinct(), "entries")
        self.bins = written(prefixes.select("class", "bins").dropDuplicates(["class"]), "bins")
        discard(prefixes)
        leader = F.min(F.struct("place", "n", "class")).alias("leader")
        self.columns = written(self.entries.groupBy("column").agg(leader, F.min("n").alias("smallest")), "columns")

        led = written(self._led(), "pairs")
        links = self._linked(self._bounded(led))
        second = self._bounded(self._between(components(links)).join(led, ["a", "b"], "left_anti"))
        self.links = links if second.isEmpty() else written(links.union(self._linked(second)), "links")
        self.labels = components(self.links)

    def _read(self) -> DataFrame:
        """One row a document (doc_id, class, n_shingles), and rows (class = n-gram, n) for common n-grams."""
        n, names = self.n, ["doc_id", "hash", "class", "n_shingles", "n"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[np.ndarray] = []

            def counted() -> pa.RecordBatch:
                gram, counts = _common_of(held)
                held.clear()
                empty = pa.nulls(len(gram), pa.int64())
                return pa.RecordBatch.from_arrays([empty.cast(kind), empty, pa.array(gram), empty, pa.array(counts)], names=names)

            kind = pa.int64()
            for batch in text_slices(batches, "text"):
                kind = batch["doc_id"].type
                gram, bounds = shingle_sets(batch["text"], n)
                held.append(gram)
                columns = [batch["doc_id"], batch["hash"], pa.array(set_hashes(gram, bounds)), pa.array(np.diff(bounds).astype(np.int64)), pa.nulls(batch.num_rows, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                if sum(map(len, held)) >= COUNT_BLOCK:
                    yield counted()
            yield counted()

        schema = self.docs.select("doc_id").schema.add("hash", "long").add("class", "long").add("n_shingles", "long").add("n", "long")
        return written(self.docs.mapInArrow(run, schema), "sets-read")

    def _prefixes(self, common: list[int]) -> DataFrame:
        """class, n and the first columns of each class's row; ``common`` columns lie last, in the order given."""
        n, percent = self.n, self.percent
        keys = np.array(common, np.int64).view(np.uint64)
        order = np.argsort(keys)
        sent = self.docs.sparkSession.sparkContext.broadcast((keys[order], order.astype(np.int64) + 1))  # at most COMMON

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, rank = sent.value
            for batch in text_slices(batches, "text"):
                gram, bounds = shingle_sets(batch["text"], n)
                sizes = np.diff(bounds)
                row = np.repeat(np.arange(len(sizes)), sizes)
                late = np.zeros(len(gram), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
                    late = np.where(known[at] == gram, rank[at], 0)
                ordered = gram[np.lexsort((gram, late, row))]
                length = np.where(sizes > 0, sizes - -(-sizes * percent // 100) + 1, 0)
                place = np.arange(len(gram)) - np.repeat(bounds[:-1], sizes)
                chosen = ordered[place < np.repeat(length, sizes)].view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(chosen))
                counts = np.bincount(row * BINS + (gram >> np.uint64(40)).astype(np.int64) % BINS, minlength=len(sizes) * BINS).astype("<u4").tobytes()
                bins = pa.array([counts[4 * BINS * i : 4 * BINS * (i + 1)] for i in range(len(sizes))], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(set_hashes(gram, bounds)), pa.array(sizes.astype(np.int64)), lists, bins], names=["class", "n", "prefix", "bins"])

        return self.docs.select("text").mapInArrow(run, "class long, n long, prefix array<long>, bins binary")

    def _row(self, other: DataFrame) -> Column:
        return self.docs["doc_id"].eqNullSafe(other["id"]) & self.docs["hash"].eqNullSafe(other["row_hash"])

    def _texts_of(self, pairs: DataFrame) -> DataFrame:
        """class and text of one document of each class in ``pairs``."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        ids = self.classes.join(wanted, "class", "left_semi").select("class", F.col("kept.doc_id").alias("id"), F.col("kept.hash").alias("row_hash"))
        ids = _few(written(ids, "wanted"))
        return written(self.docs.join(ids, self._row(ids)).select("class", "text"), "texts")

    def _possible(self, a: str, b: str) -> Column:
        """Whether sizes and places in the shared column let two entries reach the bound."""
        x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
        overlap = F.least(x - F.col(f"{a}.place"), y - F.col(f"{b}.place"))
        return (100 * F.least(x, y) >= self.percent * F.greatest(x, y)) & ((100 + self.percent) * overlap >= self.percent * (x + y))

    def _led(self) -> DataFrame:
        """Pairs (a < b) of each entry with its column's leader."""
        joined = self.entries.select("column", F.struct("place", "n", "class").alias("x")).join(self.columns, "column")
        pairs = joined.where((F.col("x.class") != F.col("leader.class")) & self._possible("x", "leader"))
        return pairs.select(F.least("x.class", "leader.class").alias("a"), F.greatest("x.class", "leader.class").alias("b")).distinct()

    def _between(self, labels: DataFrame) -> DataFrame:
        """Pairs (a < b) of a column's entries in different components, one of them not in its largest."""
        entries = self.entries.join(labels.select(F.col("node").alias("class"), "label"), "class", "left")
        entries = entries.withColumn("label", F.coalesce("label", "class"))
        # the largest partner with which an entry can reach the bound must not be below the column's smallest row
        reach = (100 + self.percent) * (F.col("n") - F.col("place")) - self.percent * F.col("n")
        entries = written(entries.join(self.columns.select("column", "smallest"), "column").where(reach >= self.percent * F.col("smallest")).drop("smallest"), "entries")
        groups = entries.groupBy("column", "label").agg(F.count("*").alias("rows"))
        columns = groups.groupBy("column").agg(F.max(F.struct("rows", "label")).alias("largest"), F.count("*").alias("labels")).where("labels > 1")
        columns = written(columns.select("column", F.col("largest.label").alias("largest")), "split-columns")
        open_ = entries.join(columns, "column").select("column", "largest", F.struct("place", "n", "class", "label").alias("x"))
        rest = open_.where("x.label <> largest").select("column", F.col("x").alias("y"))
        pairs = open_.join(rest, "column").where((F.col("x.label") != F.col("y.label")) & self._possible("x", "y"))
        return pairs.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()

    def _bounded(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose counts in bins leave room for the overlap that they need; written."""
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), "<u4").reshape(-1, BINS).astype(np.int64) for c in ("x", "y"))
                good = pa.array((100 + percent) * np.minimum(x, y).sum(axis=1) >= percent * (x.sum(axis=1) + y.sum(axis=1)))
                yield pa.RecordBatch.from_arrays([batch["a"].filter(good), batch["b"].filter(good)], names=["a", "b"])

        x = self.bins.select(F.col("class").alias("a"), F.col("bins").alias("x"))
        y = self.bins.select(F.col("class").alias("b"), F.col("bins").alias("y"))
        return written(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "pairs")

    def _linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose whole overlap reaches the bound."""
        n, percent = self.n, self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text_slices(iter([batch]), "x"):
                    for block in text_slices(iter([part]), "y"):
                        x, y = shingle_sets(block["x"], n), shingle_sets(block["y"], n)
                        sizes = np.diff(x[1]), np.diff(y[1])
                        overlap = shared(x, y)
                        good = pa.array(100 * overlap >= percent * (sizes[0] + sizes[1] - overlap))
                        yield pa.RecordBatch.from_arrays([block["a"].filter(good), block["b"].filter(good)], names=["a", "b"])

        texts = self._texts_of(pairs)
        x = texts.select(F.col("class").alias("a"), F.col("text").alias("x"))
        y = texts.select(F.col("class").alias("b"), F.col("text").alias("y"))
        links = written(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")
        discard(texts)
        return links

    def _labelled(self) -> DataFrame:
        """The classes with the label of their component."""
        labels = self.labels.select(F.col("node").alias("class"), "label")
        return self.classes.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))

    def documents(self) -> DataFrame:
        """doc_id, n_shingles and component_id of every row."""
        labelled = self._labelled()
        first = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
        named = written(labelled.select("class", "label").join(first, "label").select("class", "component_id"), "components")
        rows = self.rows.join(named, "class", "left")
        return rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))

    def others(self) -> tuple[DataFrame, DataFrame]:
        """(id, row_hash) of the rows linked to a row before them, and of rows found several times that are first."""
        labelled = self._labelled()
        first = labelled.groupBy("label").agg(F.min("kept").alias("first"))
        named = written(labelled.select("class", "label").join(first, "label").select("class", "first"), "firsts")
        rows = self.rows.where("n_shingles > 0").groupBy("class", "doc_id", "hash").agg(F.count("*").alias("n")).join(named, "class")
        rows = rows.withColumn("is_first", F.struct("doc_id", "hash").eqNullSafe(F.col("first")))
        rows = written(rows.select(F.col("doc_id").alias("id"), F.col("hash").alias("row_hash"), "n", "is_first"), "row-names")
        return rows.where("NOT is_first").select("id", "row_hash"), rows.where("is_first AND n > 1").select("id", "row_hash")


def keep_first(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs`` without those linked to one with a smaller doc_id: one row of each component stays.

    A row is known by its doc_id and text, so rows with equal ids and texts that don't link all stay."""
    gone, again = (_few(written(x, "rows")) for x in JaccardJoin(docs, n, percent).others())
    packed = docs.select(F.struct("*").alias("document"), F.col("doc_id").alias("this"), F.xxhash64("text").alias("hash"))

    def is_in(names: DataFrame) -> Column:
        return packed["this"].eqNullSafe(names["id"]) & packed["hash"].eqNullSafe(names["row_hash"])

    kept = packed.join(gone, is_in(gone), "left_anti")
    if again.isEmpty():
        return kept.select("document.*")
    once = kept.join(again, is_in(again), "left_semi").dropDuplicates(["this", "hash"])
    return kept.join(again, is_in(again), "left_anti").unionByName(once).select("document.*")
