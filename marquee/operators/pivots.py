"""Exact nearest neighbours of many requests by pivot (Voronoi) partitions.

Vectors are taken as unit vectors, so the cosine orders them like the Euclidean distance, which is a
metric. Candidates fall to the nearest of a bounded number of pivots. A request is first scored
against the cell of its own pivot; its k-th distance there, and the distances of each cell's
nearest members to their pivot, bound the distance of its k-th neighbour. Triangle and hyperplane
inequalities then rule out cells that cannot hold a neighbour, and only the others are joined. For that,
cells lie together in blocks of ``WIDE`` candidates (a larger cell is cut into several), and a request goes
once to each block, with the cells it needs there. Where little can be ruled out, as with vectors
that lie in no clusters, requests are copied once in ``WIDE`` candidates and not once a cell.

What grows with the data is never collected: tasks get the pivots (``PIVOTS`` at most) and k + 1 distances
a pivot. Zero vectors have a cosine of 0 with everything: of zero candidates only the first ids count,
and zero requests take the first ids.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.neighbours import SCORE_DIGITS, _NEAR, _candidate_rows, _query_rows, best, found_in_cells
from marquee.operators.relational import top_k_per_group
from marquee.session import cut_lineage

#: Pivots at most; below that the square root of the candidates.
PIVOTS = 1024
#: Candidates, and requests, of one block.
WIDE = 16_384
# Requests whose bounds are worked out at a time (each holds k + 1 numbers a pivot), or that are scored at a time.
_ROWS = 256
# Distances are exact to about 1e-8 (square roots of rounded cosines).
_SLACK = 1e-6


def _distance(cos: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * cos, 0.0))


def _unit(vectors: pd.Series, norms: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()) / norms.to_numpy()[:, None]


def _blocks(sizes: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each cell, which hold ``wide`` candidates at most, and into how many parts its block is cut: a
    larger cell is a block of its own."""
    block, parts, here, held = np.zeros(len(sizes), np.int32), np.ones(len(sizes), np.int32), 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > wide:
            here, held = here + 1, 0
        block[i], held = here, held + size
        parts[i] = max(1, -(-int(size) // wide))
    return block, parts


class _Cells:
    """What tasks know of the cells: pivots, and the least, largest and k + 1 smallest distances of their members."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.between = _distance(pivots @ pivots.T)

    def measure(self, rows: list, k: int) -> None:
        m = len(self.pivots)
        self.least, self.largest, self.near = np.full(m, np.inf), np.full(m, -np.inf), np.full((m, k + 1), np.inf)
        for r in rows:
            self.least[r["cluster"]], self.largest[r["cluster"]] = r["near"][0], r["largest"]
            self.near[r["cluster"], : len(r["near"])] = r["near"]
        sizes = np.zeros(m, np.int64)
        for r in rows:
            sizes[r["cluster"]] = r["size"]
        self.block, self.parts = _blocks(sizes, WIDE)

    def reach(self, unit: np.ndarray, home: np.ndarray, kth: np.ndarray, wanted: int) -> np.ndarray:
        """Which cells can hold one of the ``wanted`` nearest of each request, besides its own (requests x cells)."""
        d = _distance(unit @ self.pivots.T)
        uppers = (d[:, :, None] + self.near).reshape(len(unit), -1)
        upper = np.full(len(unit), np.inf)
        if wanted <= uppers.shape[1]:
            upper = np.partition(uppers, wanted - 1, axis=1)[:, wanted - 1]
        upper = np.fmin(upper, _distance(kth))  # a NaN tells of fewer than k in the cell
        upper = np.sqrt(upper**2 + 2 * _NEAR) + _SLACK
        own = d[np.arange(len(unit)), home]
        apart = self.between[home]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(apart > _SLACK, (d**2 - own[:, None] ** 2) / (2 * apart), 0.0)
        lower = np.maximum(np.maximum(d - self.largest, self.least - d), plane)
        good = lower <= upper[:, None]
        good[np.arange(len(unit)), home] = False
        return good & (self.largest >= 0)


def _block_kernel(k: int, exclude_self: bool):
    """The k best candidates of each request in the cells it needs of a block, if they reach its k-th similarity so far."""

    def run(_key, sp: pd.DataFrame, cp: pd.DataFrame) -> pd.DataFrame:
        rows, columns, found = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0)]
        if len(sp) and len(cp):
            names, cell = np.unique(cp["cluster"].to_numpy(), return_inverse=True)
            ids, vectors, norms = cp["candidate_id"].to_numpy(), np.stack(cp["c_vec"].to_numpy()), cp["c_nrm"].to_numpy()
            for at in range(0, len(sp), _ROWS):
                x = sp.iloc[at : at + _ROWS]
                need = np.stack([np.isin(names, c) for c in x["cells"]])
                some = np.flatnonzero(need.any(axis=0)[cell])  # candidates that a request of these needs
                sims = np.stack(x["q_vec"].to_numpy()) @ vectors[some].T / np.outer(x["q_nrm"].to_numpy(), norms[some])
                least = np.nan_to_num(x["kth"].to_numpy(dtype=float), nan=-np.inf) - _NEAR
                usable = need[:, cell[some]] & (sims >= least[:, None])
                if exclude_self:
                    usable &= x["query_id"].to_numpy()[:, None] != ids[some][None, :]
                many = usable.sum(axis=1) > k
                usable[many] = best(sims[many], usable[many], k)
                r, c = np.nonzero(usable)
                rows.append(at + r)
                columns.append(some[c])
                found.append(sims[r, c])
        r, c = np.concatenate(rows), np.concatenate(columns)
        return pd.DataFrame({"request_id": sp["request_id"].to_numpy()[r], "query_id": sp["query_id"].to_numpy()[r],
                             "candidate_id": cp["candidate_id"].to_numpy()[c], "similarity": np.concatenate(found)})

    return run


class PivotSearch:
    """The k nearest candidates of each request; ``result`` and the numbers of pairs that were scored."""

    def __init__(self, requests: DataFrame, req_vectors: DataFrame, candidates: DataFrame, k: int, exclude_self: bool = True, pivots: int = PIVOTS):
        self.k, self.exclude_self = k, exclude_self
        queries, others = _query_rows(requests, req_vectors), _candidate_rows(candidates)
        first = others.orderBy("candidate_id").limit(k + 1)  # enough where all score 0
        parts = [self._zeros(queries.where("q_nrm = 0"), first), self._zeros(queries.where("q_nrm > 0"), others.where("c_nrm = 0").orderBy("candidate_id").limit(k + 1))]

        usable = others.where("c_nrm > 0")
        count = max(1, min(pivots, math.isqrt(usable.count())))
        chosen = usable.orderBy(F.xxhash64("candidate_id"), "candidate_id").limit(count).select("c_vec", "c_nrm").toPandas()  # PIVOTS vectors at most
        self.homes = None
        if len(chosen):
            cells = _Cells(_unit(chosen["c_vec"], chosen["c_nrm"]))
            self.candidates = cut_lineage(self._assigned(usable, "c_vec", "c_nrm", cells))
            near = F.slice(F.array_sort(F.collect_list("distance")), 1, k + 1).alias("near")
            smallest = top_k_per_group(self.candidates.select("cluster", "distance"), ["cluster"], [F.col("distance").asc()], k + 1).groupBy("cluster").agg(near)
            largest = self.candidates.groupBy("cluster").agg(F.max("distance").alias("largest"), F.count(F.lit(1)).alias("size"))
            cells.measure(smallest.join(largest, "cluster").collect(), k)  # k + 1 numbers a pivot

            self.homes = cut_lineage(self._assigned(queries.where("q_nrm > 0"), "q_vec", "q_nrm", cells).drop("distance"))
            scored = self.candidates.drop("distance")
            home = cut_lineage(self._cut(found_in_cells(self.homes, scored, k, exclude_self)))
            kth = home.where(F.col("rank") == k).select("request_id", F.col("similarity").alias("kth"))
            self.cells = cells
            self.sought = self.homes.join(kth, "request_id", "left")
            far = self._cut(self._far(scored))
            parts += [home.drop("rank"), far.drop("rank")]
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        self.result = self._cut(every)

    def _cut(self, found: DataFrame) -> DataFrame:
        scored = found.withColumn("similarity", F.round("similarity", SCORE_DIGITS))
        return top_k_per_group(scored, ["request_id"], [F.col("similarity").desc(), F.col("candidate_id").asc()], self.k)

    def _zeros(self, queries: DataFrame, candidates: DataFrame) -> DataFrame:
        """Pairs with a zero vector; ``candidates`` are k + 1 rows at most."""
        pairs = queries.select("request_id", "query_id").join(F.broadcast(candidates.select("candidate_id")))
        if self.exclude_self:
            pairs = pairs.where("query_id <> candidate_id")
        return pairs.withColumn("similarity", F.lit(0.0))

    @staticmethod
    def _assigned(rows: DataFrame, vec: str, nrm: str, cells: _Cells) -> DataFrame:
        """``rows`` with the nearest pivot as ``cluster``, and its ``distance``."""

        def run(parts):
            for p in parts:
                cos = _unit(p[vec], p[nrm]) @ cells.pivots.T if len(p) else np.zeros((0, len(cells.pivots)))
                at = cos.argmax(axis=1)
                yield p.assign(cluster=at.astype("int32"), distance=_distance(cos[np.arange(len(p)), at]))

        return rows.mapInPandas(run, rows.select("*", F.lit(0).alias("cluster"), F.lit(0.0).alias("distance")).schema)

    def _away(self, vectors: bool) -> DataFrame:
        """A row for each request and each block with other cells that can hold a neighbour, and these cells;
        with the request's vector, norm and k-th similarity if ``vectors``."""
        wanted, cells = self.k + int(self.exclude_self), self.cells
        columns = [c for c in self.sought.columns if c != "cluster" and (vectors or c not in ("q_vec", "q_nrm", "kth"))]

        def run(parts):
            for p in parts:
                for at in range(0, len(p), _ROWS):
                    x = p.iloc[at : at + _ROWS]
                    good = cells.reach(_unit(x["q_vec"], x["q_nrm"]), x["cluster"].to_numpy(), x["kth"].to_numpy(dtype=float), wanted)
                    row, cell = np.nonzero(good)
                    block = cells.block[cell]
                    first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
                    if len(first):
                        out = x[columns].iloc[row[first]]
                        yield out.assign(block=block[first], parts=cells.parts[cell[first]], cells=np.array([*np.split(cell.astype("int32"), first[1:]), None], object)[:-1])

        schema = self.sought.select(*columns, F.lit(0).alias("block"), F.lit(0).alias("parts"), F.array(F.lit(0)).alias("cells")).schema
        return self.sought.mapInPandas(run, schema)

    def _far(self, candidates: DataFrame) -> DataFrame:
        """The k best candidates of each request in each block, in cells besides its own."""
        cells, k, exclude_self = self.cells, self.k, self.exclude_self
        asked = max(1, math.ceil(self.homes.count() / WIDE))  # blocks of requests
        queries = self._away(True).withColumns({
            "c_part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)), "s_block": F.pmod(F.xxhash64("request_id"), F.lit(asked)).cast("int")}).drop("parts")
        at = F.col("cluster")
        blocks, parts = (F.array(*[F.lit(int(v)) for v in values])[at] for values in (cells.block, cells.parts))
        dealt = candidates.withColumns({
            "block": blocks, "c_part": F.pmod(F.xxhash64("candidate_id"), parts).cast("int"), "s_block": F.explode(F.sequence(F.lit(0), F.lit(asked - 1)))})
        key = ["block", "c_part", "s_block"]
        return queries.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInPandas(
            _block_kernel(k, exclude_self), "request_id bigint, query_id bigint, candidate_id bigint, similarity double")

    def pairs(self) -> DataFrame:
        """One row: requests, candidates, and how many of their pairs were scored."""
        sizes = self.candidates.groupBy("cluster").agg(F.count("*").alias("size"))
        rows = self.homes.select("cluster").unionAll(self._away(False).select(F.explode("cells").alias("cluster"))).groupBy("cluster").agg(F.count("*").alias("sent"))
        scored = rows.join(sizes, "cluster").agg(F.coalesce(F.sum(F.col("sent") * F.col("size")), F.lit(0)).alias("pairs_scored"))
        both = self.homes.agg(F.count("*").alias("requests")).crossJoin(self.candidates.agg(F.count("*").alias("candidates")))
        return both.crossJoin(scored)  # one row each


def knn_pivots(requests: DataFrame, req_vectors: DataFrame, candidates: DataFrame, k: int, exclude_self: bool = True) -> DataFrame:
    """The rows of ``knn_scan`` without scoring all pairs, where the vectors lie in clusters."""
    return PivotSearch(requests, req_vectors, candidates, k, exclude_self).result
