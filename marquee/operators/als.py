"""Alternating least squares (M7, M8, M10b) whose factors stay in files, so that an iteration shuffles nothing.

The ratings are dealt twice, by item and by user, range-partitioned, sorted and written as one Parquet file a task. A half
iteration is one narrow job over one of the two: a task reads its file batch by batch, adds up the normal equations of one
item (or user) after another and solves them. It takes the factors it meets on the other side from the files that the tasks of the half before have
written to the shared folder, by position (the files are mapped, not loaded). So an iteration writes every factor once,
where ``pyspark.ml``'s ALS shuffles it once for nearly every block of the other side. The driver gets a row for each file.

The equations, their order and the start are those of ``pyspark.ml.recommendation.ALS``: the start is its fit without
iterations, and a rating's weight and the regularisation (times the number of ratings) follow its explicit and implicit
forms.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.io import shared_path, write_table

#: Ratings of a task at least, and tasks for each core at most: tasks hold a batch of rows, whatever their number.
TASK_ROWS, CORE_TASKS = 50_000, 4
#: Ratings of a batch of a task's file: it holds at most so many equations at a time.
BATCH_ROWS = 4096
#: Users and items of a block of scores.
SCORE_USERS, SCORE_ITEMS = 512, 8192
_PART = "path string, first bigint, last bigint, n bigint, gram array<double>"


def _place(uri: str):
    """The file system and path of a folder of Spark's."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri.removeprefix("file:"))


def _row(rank: int, kind: str = "<f4") -> np.dtype:
    return np.dtype([("code", "<i8"), ("vec", kind, (rank,))])


def discard(uri: str) -> None:
    """Delete a folder that nothing reads any more."""
    fs, path = _place(uri)
    fs.delete_dir(path)


@dataclass
class Factors:
    """Files of (code, vec) rows in code order; one side of a model."""

    folder: str
    rank: int
    parts: list  # path, first and last code, number of rows, V^T V
    kind: str = "<f4"

    def open(self, i: int) -> np.ndarray:
        """The rows of a file, mapped where the file system is local."""
        fs, path = _place(self.parts[i][0])
        if isinstance(fs, pafs.LocalFileSystem):
            return np.memmap(path, _row(self.rank, self.kind), "r").view(np.ndarray)  # rows of a plain array are cheaper to take
        with fs.open_input_file(path) as f:
            return np.frombuffer(f.read(), _row(self.rank, self.kind))

    def gram(self) -> np.ndarray:
        return sum(np.array(p[4]) for p in self.parts).reshape(self.rank, self.rank)

    def discard(self) -> None:
        discard(self.folder)

    def vectors(self, codes: DataFrame) -> DataFrame:
        """id, features (array<float>) of the rows of ``codes`` (id, code) that have factors. The files are looked up by
        position, so no factor is shuffled, or broadcast by a guess at the size of rows that Python makes."""
        side = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup = _Lookup(side)
            for batch in batches:
                at, vecs = lookup.find(batch.column("code").to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), _lists(vecs.astype(np.float32))], names=["id", "features"])

        kind = T.StructType([codes.schema["id"], T.StructField("features", T.ArrayType(T.FloatType()))])
        return _by_code(codes, len(self.parts)).mapInArrow(run, kind)


def _lists(vecs: np.ndarray) -> pa.ListArray:
    ends = np.arange(0, vecs.size + 1, vecs.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(vecs).ravel()))


def _by_code(codes: DataFrame, tasks: int) -> DataFrame:
    """(id, code) dealt by ranges of codes: a task meets the rows of few files."""
    known = codes.select("id", F.col("code").cast("bigint").alias("code")).where(F.col("code").isNotNull())
    return known.repartitionByRange(max(1, tasks), "code")


def _numbers(spark: SparkSession, n: int) -> DataFrame:
    """i = 0..n-1, one a task."""
    return spark.range(0, n, 1, n).withColumnRenamed("id", "i")


class _Lookup:
    """Factors of any codes of a side."""

    def __init__(self, side: Factors):
        self.side, self.rows = side, {}
        self.first = np.array([p[1] for p in side.parts])

    def take(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty((len(codes), self.side.rank))
        part = np.searchsorted(self.first, codes, side="right") - 1
        order = np.argsort(part, kind="stable")
        edges = np.flatnonzero(np.diff(part[order])) + 1
        for at in np.split(order, edges):
            i = int(part[at[0]])
            if i not in self.rows:
                self.rows[i] = self.side.open(i)
            rows, (_, first, last, n, _) = self.rows[i], self.side.parts[i]
            where = codes[at] - first if last - first + 1 == n else np.searchsorted(rows["code"], codes[at])
            out[at] = rows["vec"][where]
        return out

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``codes`` have factors, by position and once for each, and these factors."""
        out_at, out = [np.zeros(0, np.int64)], [np.zeros((0, self.side.rank))]
        part = np.searchsorted(self.first, codes, side="right") - 1
        for i in np.unique(part[part >= 0]).tolist():
            if i not in self.rows:
                self.rows[i] = self.side.open(i)
            at = np.flatnonzero(part == i)
            low, high = (np.searchsorted(self.rows[i]["code"], codes[at], side=x) for x in ("left", "right"))
            n = high - low
            where = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out_at.append(np.repeat(at, n))
            out.append(self.rows[i]["vec"][where])
        at = np.concatenate(out_at)
        order = np.argsort(at, kind="stable")
        return at[order], np.concatenate(out)[order]


def _stored(solved: Iterator[tuple[np.ndarray, np.ndarray]], folder: str, rank: int, kind: str = "<f4") -> Iterator[pa.RecordBatch]:
    """Writes one file of the (codes, vecs) that come, in code order, and passes on its entry."""
    path, first, last, n, gram = f"{folder}/{uuid.uuid4().hex}", None, None, 0, np.zeros((rank, rank))
    fs, target = _place(path)
    out = None
    for codes, vecs in solved:
        rows = np.empty(len(codes), _row(rank, kind))
        rows["code"], rows["vec"] = codes, vecs
        out = fs.open_output_stream(target) if out is None else out
        out.write(rows.tobytes())
        kept = rows["vec"].astype(float)
        first, last, n, gram = codes[0] if first is None else first, codes[-1], n + len(codes), gram + kept.T @ kept
    if out is not None:
        out.close()
        yield pa.RecordBatch.from_pylist([{"path": path, "first": int(first), "last": int(last), "n": n, "gram": gram.ravel().tolist()}])


def _sums(f: np.ndarray, rating: np.ndarray, start: np.ndarray, alpha: float | None):
    """F^T W F, F^T W r and the number of ratings of each run of rows; ``alpha`` for implicit ratings."""
    end, rank = np.append(start[1:], len(f)), f.shape[1]
    a, b = np.empty((len(start), rank, rank)), np.empty((len(start), rank))
    if alpha is None:
        weighted, target, counted = f, rating, np.ones(len(f))
    else:
        weight = alpha * np.abs(rating)
        weighted, target, counted = f * weight[:, None], np.where(rating > 0, 1 + weight, 0.0), (rating > 0).astype(float)
    for k, (x, y) in enumerate(zip(start.tolist(), end.tolist())):
        a[k] = weighted[x:y].T @ f[x:y]
        b[k] = target[x:y] @ f[x:y]
    return a, b, np.add.reduceat(counted, start)


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _solved(batches: Iterator[pa.RecordBatch], other: Factors, reg: float, alpha: float | None, some: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vector of every code of rows (code, other, rating) that come sorted by code. Sums of the last code of a batch
    wait for the next, so a code may have any number of rows. With ``some``, rows count once for each factor of their
    other code, which may have none."""
    lookup, base = _Lookup(other), None if alpha is None else other.gram()

    def solve(codes, a, b, n):
        if base is not None:
            a += base
        a.reshape(len(a), -1)[:, :: other.rank + 1] += (reg * n)[:, None]  # the diagonals
        return codes, np.linalg.solve(a, b[:, :, None])[:, :, 0]

    held = None
    for batch in _short(batches):
        code, known, rating = (batch.column(i).to_numpy() for i in range(3))
        if some:
            at, f = lookup.find(known)
            code, rating = code[at], rating[at]
        else:
            f = lookup.take(known)
        if not len(code):
            continue
        start = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        found = (code[start], *_sums(f, rating.astype(float), start, alpha))
        if held is not None:
            if held[0][0] == code[0]:
                for mine, before in zip(found[1:], held[1:]):
                    mine[0] += before[0]
            else:
                yield solve(*held)
        held = tuple(x[-1:].copy() for x in found)
        if len(start) > 1:
            yield solve(*(x[:-1] for x in found))
    if held is not None:
        yield solve(*held)


def _written(jobs: DataFrame, folder: str, rank: int, kind: str = "<f4") -> Factors:
    """Runs the tasks that write a side."""
    return Factors(folder, rank, sorted((tuple(r) for r in jobs.collect()), key=lambda p: p[1]), kind)


def _folder(spark: SparkSession, name: str) -> str:
    folder = shared_path(spark, name)
    fs, path = _place(folder)
    fs.create_dir(path, recursive=True)
    return folder


def _dealt(df: DataFrame, code: str, rest: list[str], tasks: int) -> DataFrame:
    return df.select(code, *rest).repartitionByRange(tasks, code).sortWithinPartitions(code)


def stored_factors(factors: DataFrame, rank: int, tasks: int, kind: str = "<f4") -> Factors:
    """(id, features) as files."""
    folder = _folder(factors.sparkSession, "factors")

    def rows(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.column(0).to_numpy(), np.stack(batch.column(1).to_numpy(zero_copy_only=False))

    stored = _dealt(factors, "id", ["features"], tasks).mapInArrow(lambda batches: _stored(rows(batches), folder, rank, kind), _PART)
    return _written(stored, folder, rank, kind)


def positions(factors: DataFrame, tasks: int) -> Factors:
    """Factors (id, vec) as files that are read by position. Ids may come twice; rows without one are left out."""
    known = factors.where(F.col("id").isNotNull()).select("id", F.col("vec").alias("features"))
    rank = known.agg(F.max(F.size("features"))).first()[0] or 0
    return stored_factors(known, rank, tasks, "<f8")


@dataclass
class Dealt:
    """Ratings by item and by user. A file holds all rows of its codes, sorted by them."""

    by_item: str  # folders
    by_user: str
    tasks: int

    def discard(self) -> None:
        discard(self.by_item)
        discard(self.by_user)


def deal(data: DataFrame) -> Dealt:
    """The ratings ``data`` (_u, _i, rating), dealt and written twice. ``data`` is read several times: pass a written table."""
    tasks = min(-(-data.count() // TASK_ROWS), CORE_TASKS * data.sparkSession.sparkContext.defaultParallelism)

    def side(code: str, other: str) -> str:
        return write_table(_dealt(data, code, [other, "rating"], tasks), "dealt", one_file=True)

    return Dealt(side("_i", "_u"), side("_u", "_i"), tasks)


def _batches(path: str, rows: int) -> Iterator[pa.RecordBatch]:
    fs, at = _place(path)
    with fs.open_input_file(at) as f:
        yield from pq.ParquetFile(f).iter_batches(rows)


def half(spark: SparkSession, dealt: str, other: Factors, reg: float, alpha: float | None) -> Factors:
    """The side by whose codes the files of the folder ``dealt`` are sorted, solved against the other one."""
    folder, rank, size = _folder(spark, "factors"), other.rank, BATCH_ROWS
    files = sorted(spark.read.parquet(dealt).inputFiles())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("i").to_pylist():
                yield from _stored(_solved(_batches(files[i], size), other, reg, alpha), folder, rank)

    return _written(_numbers(spark, len(files)).mapInArrow(run, _PART), folder, rank)


def iterate(dealt: Dealt, users: DataFrame, rank: int, reg: float, max_iter: int, alpha: float | None) -> tuple[Factors, Factors]:
    """User and item factors after ``max_iter`` iterations (at least 1) over the ratings ``dealt``, started from
    ``users`` (id, features). ``alpha`` is None for explicit ratings."""
    spark = users.sparkSession
    user, item = stored_factors(users, rank, dealt.tasks), None
    for _ in range(max_iter):
        before, item = item, half(spark, dealt.by_item, user, reg, alpha)
        old, user = user, half(spark, dealt.by_user, item, reg, alpha)
        for x in (before, old):
            if x is not None:
                x.discard()
    return user, item


def dots(users: Factors, items: Factors):
    """A function of two columns of codes: the product of their factors, added up from the first factor to the last in
    single precision; null where a code has no factors."""

    @F.arrow_udf("float")
    def dot(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sides = _Lookup(users), _Lookup(items)
        for codes in pairs:
            total, found, rows = np.zeros(len(codes[0]), np.float32), np.zeros(len(codes[0]), int), []
            for side, code in zip(sides, codes):
                at, vecs = side.find(code.fill_null(-1).to_numpy(zero_copy_only=False))
                rows.append(np.zeros((len(total), side.side.rank), np.float32))
                rows[-1][at] = vecs
                found[at] += 1
            for x, y in zip(*(r.T for r in rows)):
                total += x * y
            yield pa.array(total, mask=found < 2)

    return dot


def best_items(users: Factors, items: Factors, n: int, codes: DataFrame) -> DataFrame:
    """id, item (a code), score and rank of the n best items of every user of ``codes`` (id, code), ties by item. A task
    scores its users against one block of items after another and keeps n of them, so no list but the last leaves it."""

    def cut_to_n(row, score, code):
        """The n best of each row, and their places."""
        order = np.lexsort((code, -score, row))
        row, score, code = row[order], score[order], code[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < n
        return row[keep], score[keep], code[keep], place[keep]

    def best(u: np.ndarray):
        """Lists are cut once for many blocks: the bound of a row may be that of an earlier block."""
        found, more, cut = [], 0, np.full(len(u), -np.inf, np.float32)
        for i in range(len(items.parts)):
            rows = items.open(i)
            for at in range(0, len(rows), SCORE_ITEMS):
                block = rows[at : at + SCORE_ITEMS]
                s = u @ np.ascontiguousarray(block["vec"]).T
                if (cut == -np.inf).any():
                    over = (s > cut[:, None]) | (cut == -np.inf)[:, None]
                    if s.shape[1] > n:  # the block's own n-th score bounds the list
                        over &= s >= -np.partition(-s, n - 1, axis=1)[:, n - 1][:, None]
                else:
                    over = s > cut[:, None]
                r, c = np.divmod(np.flatnonzero(over), s.shape[1])  # a tenth of the time of nonzero over two dimensions
                if not len(r):
                    continue
                found.append((r, s[r, c], block["code"][c]))
                more += len(r)
                if len(found) == 1 or more > len(u) * n or (cut == -np.inf).any():
                    row, score, code, place = cut_to_n(*(np.concatenate(x) for x in zip(*found)))
                    cut[row[place == n - 1]] = score[place == n - 1]
                    found, more = [(row, score, code)], 0
        return cut_to_n(*(np.concatenate(x) for x in zip(*found)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(users)
        for batch in batches:
            for at in range(0, batch.num_rows, SCORE_USERS):
                part = batch.slice(at, SCORE_USERS)
                known, vecs = lookup.find(part.column("code").to_numpy())
                if not len(known):
                    continue
                row, score, code, place = best(vecs.astype(np.float32))
                yield pa.RecordBatch.from_pydict({"id": part.column("id").take(pa.array(known[row])), "item": code, "score": score.astype(float), "rank": (place + 1).astype(np.int32)})

    kind = T.StructType([codes.schema["id"], T.StructField("item", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    return _by_code(codes, len(users.parts)).mapInArrow(run, kind)
