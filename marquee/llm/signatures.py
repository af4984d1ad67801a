"""Near-duplicates by an inverted join of MinHash signature coordinates (operator 11).

A document's signature has ``COORDINATES`` values: under each of as many hash functions, the smallest
hash of its word n-grams. Two documents agree on a coordinate with a probability equal to their
similarity, so linked ones agree on at least ``match_threshold`` coordinates but for a chance of ``LOSS``.
Documents with equal n-gram sets are one class, and only classes are compared:

* Each class is posted under its coordinate-value pairs, in one order for all classes: rarer pairs first.
  Classes that agree on t of m coordinates share one of their first m - t + 1 pairs, so only this
  prefix is posted and merged. The frequent rest is skipped: its collisions are looked up.
* The collisions of a candidate are counted on four bits of each coordinate, packed in longs that go
  with the class; equal values have equal bits, so no count is too low. Pairs below the threshold go,
  and so do those whose n-grams differ too much by their parities in ``PARITIES`` bins: a bin of unlike
  parity holds an n-gram of one class alone, and linked classes have few such.
* Links are confirmed on the full sets: n-grams are hashed once a class and intersected pair by pair.

A posting list is not squared. First each class is paired with one leader a list, the class with the
fewest rarer pairs: the original of a group of copies has few of its own. Only where classes of a list are then in different components, those outside the largest one
are paired with the others. Every link between components is found this way, so components are
those of all links that the signatures let through. Keys with more than ``HOT`` pairs are salted where
pairs get the bits or sets of a class, so a leader's are copied once a salt.

The order of coordinate-value pairs only affects speed. Blocks of classes pass on the pairs that they
found ``OFTEN`` times or more, and the ``COMMON`` most frequent lie last.

Defined cases: words are lower-cased in A-Z only. A text with fewer than n words is one n-gram; an
empty, blank or null text has an empty set, links with nothing and is its own component. Rows with
equal ids are rows of their own, and share a component if they link. N-grams and sets are compared
by 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import discard, written
from marquee.llm.components import components
from marquee.llm.words import mix, set_hashes, shared, shingle_sets, text_slices

COORDINATES, LOSS = 128, 1e-8
#: Pairs of one class above which they are salted; frequent coordinate-value pairs that are sent to the tasks.
HOT, COMMON, OFTEN, COUNT_BLOCK = 100_000, 1 << 17, 3, 1 << 20
PARITIES = 512
#: Bits of the largest filter that is sent to the tasks (8 MB), and probes of a key.
FILTER_BITS, PROBES = 1 << 26, 4
_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64)).reshape(2, -1) | np.uint64(1)
#: Four bits of each coordinate, in so many longs.
_BITS = [f"bits{i}" for i in range(COORDINATES // 16)]
_ODD = [f"odd{i}" for i in range(PARITIES // 64)]


def match_threshold(percent: int) -> int:
    """The most coordinates of which a pair at ``percent`` % similarity agrees on fewer with a chance of LOSS at most."""
    p, below = percent / 100, 0.0
    for t in range(COORDINATES + 1):
        below += math.comb(COORDINATES, t) * p**t * (1 - p) ** (COORDINATES - t)
        if below > LOSS:
            return max(t, 1)
    return COORDINATES


def signatures(gram: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The signature of each set, as 64-bit names of its coordinate-value pairs (sets x COORDINATES; empty sets: any)."""
    filled = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, COORDINATES), np.uint64)
    for i in range(COORDINATES if len(filled) else 0):
        out[filled, i] = np.minimum.reduceat((gram ^ _SEEDS[0, i]) * _SEEDS[1, i], bounds[filled])
    return mix(out + _SEEDS[0])


def parities(gram: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each bin has an odd number of a set's n-grams, as 64-bit values (sets x PARITIES / 64)."""
    rows = len(bounds) - 1
    at = np.repeat(np.arange(rows), np.diff(bounds)) * PARITIES + (gram >> np.uint64(40)).astype(np.int64) % PARITIES
    odd = (np.bincount(at, minlength=rows * PARITIES) & 1).astype(np.uint8).reshape(rows, PARITIES)
    return np.packbits(odd, axis=1).view("<u8")


def _lists(values: np.ndarray, length: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(values))


class SignatureJoin:
    """The join of ``docs`` (doc_id, text): ``rows``, ``classes`` and the ``labels`` of the classes that have links."""

    def __init__(self, docs: DataFrame, n: int = 5, percent: int = 85):
        self.n, self.percent, self.least = n, percent, match_threshold(percent)
        self.docs = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))  # together they name a row
        read = written(self._read(), "signatures")
        self.rows = written(read.drop("signature"), "sets")
        first = F.min(F.struct("doc_id", "hash")).alias("first")
        self.classes = written(self.rows.where("n_shingles > 0").groupBy("class").agg(first, F.min("doc_id").alias("doc_id")), "classes")
        prefixes = written(self._prefixes(read.where("n_shingles > 0").select("class", F.col("n_shingles").alias("n"), "signature")), "prefixes")
        discard(read)
        posted = prefixes.select("class", F.posexplode("prefix").alias("place", "pair"))
        order = F.col("place").cast("long") * (1 << 56) + F.shiftrightunsigned("class", 8)
        lists = posted.groupBy("pair").agg(F.min("class").alias("least"), F.max("class").alias("last"), F.min_by("class", order).alias("leader"))
        lists = written(lists.where("least <> last").select("pair", "leader"), "lists")
        lists = lists.hint("merge")  # they grow with the classes, so one plan at every size
        self.posted = written(posted.select("pair", "class").join(lists, "pair").distinct(), "posted")
        shared_some = self.posted.select("class").distinct()
        self.bits = written(prefixes.drop("prefix").join(shared_some, "class", "left_semi").dropDuplicates(["class"]), "bits")
        discard(prefixes)

        led = written(self._led(), "led")
        links = self._linked(self._matching(led))
        second = written(self._between(components(links)), "between").join(led, ["a", "b"], "left_anti")
        self.labels = components(written(links.union(self._linked(second)), "links"))

    def _read(self) -> DataFrame:
        """One row a document: doc_id, hash, class, n_shingles and signature."""
        n = self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, "text"):
                gram, bounds = shingle_sets(batch["text"], n)
                names = np.concatenate([signatures(gram, bounds), parities(gram, bounds)], axis=1).astype("<u8").tobytes()
                wide = 8 * (COORDINATES + len(_ODD))
                each = pa.array([names[i : i + wide] for i in range(0, len(names), wide)], pa.binary())
                columns = [batch["doc_id"], batch["hash"], pa.array(set_hashes(gram, bounds)), pa.array(np.diff(bounds).astype(np.int64)), each]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "hash", "class", "n_shingles", "signature"])

        schema = self.docs.select("doc_id").schema.add("hash", "long").add("class", "long").add("n_shingles", "long").add("signature", "binary")
        return self.docs.mapInArrow(run, schema)

    def _common(self, single: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """The most frequent coordinate-value pairs, sorted, and the rank of each among them (1: least frequent)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in _ended(batches):
                if batch is not None:
                    held.append(_names(batch["signature"])[0].ravel())
                    size += len(held[-1])
                if held and (batch is None or size >= COUNT_BLOCK):
                    found, counts = np.unique(np.concatenate(held), return_counts=True)
                    often = counts >= OFTEN
                    yield pa.RecordBatch.from_arrays([pa.array(found[often].view(np.int64)), pa.array(counts[often])], names=["pair", "n"])
                    held, size = [], 0

        counts = single.select("signature").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        rows = counts.orderBy(F.desc("n"), "pair").limit(COMMON).collect()  # at most COMMON
        names = np.array([r["pair"] for r in reversed(rows)], np.int64).view(np.uint64)
        order = np.argsort(names)
        return names[order], order + 1

    def _prefixes(self, single: DataFrame) -> DataFrame:
        """class, n, prefix (the first coordinate-value pairs in the order) and the bits of each class."""
        sent = self.docs.sparkSession.sparkContext.broadcast(self._common(single))
        length = COORDINATES - self.least + 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common, rank = sent.value
            for batch in batches:
                names, odd = _names(batch["signature"])
                late = np.zeros(names.shape, np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, names), len(common) - 1)
                    late = np.where(common[at] == names, rank[at], 0)
                chosen = np.take_along_axis(names, np.lexsort((names, late), axis=1)[:, :length], axis=1)
                nibbles = (names & np.uint64(15)).reshape(len(names), -1, 16) << (4 * np.arange(16, dtype=np.uint64))
                bits = nibbles.sum(axis=2, dtype=np.uint64).view(np.int64)
                columns = [batch["class"], batch["n"], _lists(chosen.ravel().view(np.int64), np.full(len(names), length))]
                columns += [pa.array(c) for c in np.concatenate([bits, odd.view(np.int64)], axis=1).T]
                yield pa.RecordBatch.from_arrays(columns, names=["class", "n", "prefix", *_BITS, *_ODD])

        return single.mapInArrow(run, "class long, n long, prefix array<long>, " + ", ".join(f"{b} long" for b in [*_BITS, *_ODD]))

    def _collide(self, x: str, y: str) -> Column:
        """Whether sizes, coordinates and parities let two classes link."""
        m, n = F.col(f"{x}n"), F.col(f"{y}n")
        apart = unlike = F.lit(0)
        for b in _BITS:
            v = F.col(f"{x}{b}").bitwiseXOR(F.col(f"{y}{b}"))
            v = v.bitwiseOR(F.shiftrightunsigned(v, 2))
            apart += F.bit_count(v.bitwiseOR(F.shiftrightunsigned(v, 1)).bitwiseAND(F.lit(0x1111111111111111)))
        for b in _ODD:
            unlike += F.bit_count(F.col(f"{x}{b}").bitwiseXOR(F.col(f"{y}{b}")))
        sizes = 100 * F.least(m, n) >= self.percent * F.greatest(m, n)
        return sizes & (apart <= COORDINATES - self.least) & ((100 + self.percent) * unlike <= (100 - self.percent) * (m + n))

    def _led(self) -> DataFrame:
        """Pairs (a < b) of each posted class with its list's leader."""
        return self.posted.where("class <> leader").select(F.col("leader").alias("a"), F.col("class").alias("b")).distinct()

    def _matching(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose signatures agree on enough coordinates."""
        joined = pairs
        for key in ("b", "a"):
            joined = self._beside(joined, key, self.bits.select("class", *[F.col(c).alias(f"{key}_{c}") for c in ("n", *_BITS, *_ODD)]))
        return joined.where(self._collide("a_", "b_")).select("a", "b")

    def _beside(self, pairs: DataFrame, key: str, side: DataFrame) -> DataFrame:
        """``pairs`` with the columns of ``side`` for the class in ``key``; classes with very many pairs are salted."""
        other = "b" if key == "a" else "a"
        hot = pairs.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > HOT)
        hot = written(hot.select(F.col(key).alias("class"), F.ceil(F.col("n") / HOT).alias("salts")), "hot")  # one row in HOT pairs at most
        if hot.isEmpty():
            return pairs.join(side.withColumnRenamed("class", key), key)
        salts = F.coalesce("salts", F.lit(1))
        copies = side.join(hot, "class", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("salts")
        dealt = pairs.join(hot.withColumnRenamed("class", key), key, "left").withColumn("salt", F.pmod(F.xxhash64(other), salts)).drop("salts")
        return dealt.join(copies.withColumnRenamed("class", key), [key, "salt"]).drop("salt")

    def _between(self, labels: DataFrame) -> DataFrame:
        """Matching pairs (a < b) of a list's classes in different components, one of them not in its largest."""
        posted = self.posted.select("pair", "class").join(labels.withColumnRenamed("node", "class"), "class", "left")
        posted = written(posted.withColumn("label", F.coalesce("label", "class")), "posted")
        groups = posted.groupBy("pair", "label").agg(F.count("*").alias("rows"))
        lists = groups.groupBy("pair").agg(F.max(F.struct("rows", "label")).alias("largest"), F.count("*").alias("labels")).where("labels > 1")
        lists = written(lists.select("pair", F.col("largest.label").alias("largest")), "split-lists")
        open_ = written(posted.join(lists, "pair").join(self.bits, "class"), "open")
        x, y = (open_.select("pair", *[F.col(c).alias(f"{k}_{c}") for c in ("class", "n", "label", "largest", *_BITS, *_ODD)]) for k in "xy")
        pairs = x.join(y.where("y_label <> y_largest").drop("y_largest"), "pair")
        once = (F.col("x_label") == F.col("x_largest")) | (F.col("x_class") < F.col("y_class"))
        pairs = pairs.where((F.col("x_label") != F.col("y_label")) & once & self._collide("x_", "y_"))
        return pairs.select(F.least("x_class", "y_class").alias("a"), F.greatest("x_class", "y_class").alias("b")).distinct()

    def _filter(self, keys: DataFrame) -> np.ndarray:
        return key_filter(keys)

    def _sets_of(self, pairs: DataFrame) -> DataFrame:
        """class and n-grams (sorted 64-bit hashes) of each class in ``pairs``; written.

        One row of each class is read. A Bloom filter of these rows of bounded size goes to the tasks, so the texts of
        other rows aren't shuffled; what it lets through wrongly is joined away.
        """
        n, row = self.n, F.xxhash64("doc_id", "hash").alias("key")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        ids = written(self.classes.join(wanted, "class", "left_semi").select("class", "first.*").select("class", row), "wanted")
        sent = self.docs.sparkSession.sparkContext.broadcast(self._filter(ids))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_slices((b.filter(pa.array(_held(sent.value, b["key"]))) for b in batches), "text"):
                gram, bounds = shingle_sets(batch["text"], n)
                names, ends = gram.astype("<u8").tobytes(), (8 * bounds).tolist()
                each = pa.array([names[a:b] for a, b in zip(ends, ends[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(set_hashes(gram, bounds)), each], names=["class", "grams"])

        sets = self.docs.select(row, "text").mapInArrow(run, "class long, grams binary").dropDuplicates(["class"])
        return written(sets.join(ids.select("class"), "class", "left_semi"), "sets")

    def _linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose whole overlap reaches the bound; written."""
        percent = self.percent

        def sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            each = column.to_pylist()
            return np.frombuffer(b"".join(each), "<u8"), np.concatenate([[0], np.cumsum([len(e) // 8 for e in each])])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text_slices(iter([batch]), "x"):
                    for block in text_slices(iter([part]), "y"):
                        x, y = sets(block["x"]), sets(block["y"])
                        overlap = shared(x, y)
                        good = pa.array(100 * overlap >= percent * (np.diff(x[1]) + np.diff(y[1]) - overlap))
                        yield pa.RecordBatch.from_arrays([block["a"].filter(good), block["b"].filter(good)], names=["a", "b"])

        pairs = written(pairs, "matching")
        found = self._sets_of(pairs)
        joined = self._beside(pairs, "b", found.withColumnRenamed("grams", "y"))
        joined = self._beside(joined, "a", found.withColumnRenamed("grams", "x"))
        links = written(joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")
        discard(found)
        return links

    def documents(self) -> DataFrame:
        """doc_id, n_shingles, component_id and kept of every row."""
        labelled = self.classes.join(self.labels.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
        first = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
        named = written(labelled.select("class", "label").join(first, "label").select("class", "component_id"), "components")
        component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        rows = self.rows.join(named, "class", "left").select("doc_id", "n_shingles", component.alias("component_id"))
        return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _names(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Coordinate-value pairs and parities of a column of signatures."""
    return np.split(np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, COORDINATES + len(_ODD)), [COORDINATES], axis=1)


def key_filter(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of ``keys`` (key: long), as 64-bit words; its size follows their number up to FILTER_BITS."""
    size = min(1 << max(16 * keys.count(), 64).bit_length(), FILTER_BITS)
    step = F.shiftrightunsigned("key", 32).bitwiseOR(F.lit(1))
    probes = [(F.col("key").bitwiseAND(F.lit((1 << 32) - 1)) + step * i).bitwiseAND(F.lit(size - 1)) for i in range(PROBES)]
    each = keys.select(F.explode(F.array(*probes)).alias("at"))
    bit = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    filled = each.groupBy(F.shiftrightunsigned("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()  # at most size / 64
    words = np.zeros(size // 64, np.int64)
    words[filled["word"].to_numpy()] = filled["bits"].to_numpy()
    return words.view(np.uint64)


def _held(words: np.ndarray, column: pa.Array) -> np.ndarray:
    """Which keys may be in the filter that ``words`` are; none that are in it is missing."""
    key = column.to_numpy(zero_copy_only=False).view(np.uint64)
    at, step, may = key & np.uint64((1 << 32) - 1), (key >> np.uint64(32)) | np.uint64(1), np.ones(len(key), bool)
    for i in range(PROBES):
        place = (at + step * np.uint64(i)) & np.uint64(64 * len(words) - 1)
        may &= (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return may


def _ended(batches: Iterator) -> Iterator:
    """The batches, then None."""
    yield from batches
    yield None
