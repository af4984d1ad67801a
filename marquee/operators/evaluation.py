"""List-comparison measures (E1-E7, W8) between two ranked lists per request.

Two long frames (request_id, rank, movie_id) with 1-based ranks and distinct ids per list become one
row per request with both lists as arrays (``paired``, a single grouping; lists are bounded by their
cut). Every measure is an expression on these two arrays. Measures take the two frames, or the paired
frame alone.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 6
RBO_P = 0.9


def paired(a: DataFrame, b: DataFrame) -> DataFrame:
    """request_id, a, b: the ids of both lists in rank order; an absent list is empty."""
    both = a.select("request_id", F.lit("a").alias("side"), "rank", "movie_id").unionByName(
        b.select("request_id", F.lit("b").alias("side"), "rank", "movie_id"))

    def ids(side):
        entries = F.collect_list(F.when(F.col("side") == side, F.struct("rank", "movie_id")))
        return F.transform(F.array_sort(entries), lambda x: x["movie_id"]).alias(side)

    return both.groupBy("request_id").agg(ids("a"), ids("b"))


def _on_lists(measure):
    @functools.wraps(measure)
    def run(a: DataFrame, b: DataFrame | None = None, *args, **kwargs) -> DataFrame:
        return measure(a if b is None else paired(a, b), *args, **kwargs)

    return run


def _seq1(n):
    """1..n, empty when n < 1 (Spark's sequence(1, 0) would count down)."""
    return F.when(n >= 1, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))


def _both(depth=None):
    """Number of ids that are in both lists, or in both of their first ``depth``."""
    a, b = F.col("a"), F.col("b")
    if depth is not None:
        a, b = F.slice(a, 1, depth), F.slice(b, 1, depth)
    return F.size(F.array_intersect(a, b))


def _shorter():
    return F.least(F.size("a"), F.size("b"))


@_on_lists
def precision_at_k(lists: DataFrame, k: int = 5) -> DataFrame:
    """|top-k(a) & top-k(b)| / k (k, not the list length)."""
    return lists.select("request_id", (_both(F.lit(k)) / F.lit(k)).alias("precision_at_k"))


@_on_lists
def intersection_size(lists: DataFrame) -> DataFrame:
    """E3."""
    return lists.select("request_id", _both().cast("bigint").alias("intersection"))


@_on_lists
def jaccard(lists: DataFrame) -> DataFrame:
    """|a & b| / |a | b|; two empty lists give null (the reference divides by zero)."""
    union = F.size(F.array_union("a", "b"))
    return lists.select("request_id", F.when(union > 0, _both() / union).alias("jaccard"))


@_on_lists
def overlap_curve(lists: DataFrame, depth: int | None = 10, bounded_by_lists: bool = False) -> DataFrame:
    """Ids common to the first d of both lists. ``depth`` fixes the depths 1..N (top-N intersections);
    ``bounded_by_lists`` uses 1..min(len_a, len_b) (the RBO depths)."""
    top = _shorter() if bounded_by_lists else F.lit(depth)
    x = lists.select("request_id", "a", "b", F.explode(_seq1(top)).alias("depth"))
    return x.select("request_id", "depth", _both(F.col("depth")).cast("bigint").alias("overlap"))


def _power(p: float, e) -> F.Column:
    """p ** e by repeated multiplication (bit-identical across engines, unlike pow)."""
    return F.aggregate(F.array_repeat(F.lit(p), e.cast("int")), F.lit(1.0), lambda acc, x: acc * x)


def _fold_sum(arr) -> F.Column:
    """Left-to-right sum starting at 0.0 (fixed association, so results do not depend on partitioning)."""
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def _rbo_terms(p: float) -> F.Column:
    """The depth-ordered terms overlap_d / d * p^(d-1), d = 1..min(len)."""
    return F.transform(_seq1(_shorter()), lambda d: _both(d) / d * _power(p, d - 1))


@_on_lists
def rbo_curve(lists: DataFrame, p: float = RBO_P) -> DataFrame:
    """Truncated RBO of the prefixes of length k = 1..min(len): (1-p) sum_{d<=k} overlap_d / d p^(d-1)."""
    t = lists.select("request_id", _rbo_terms(p).alias("terms"))
    x = t.select("request_id", "terms", F.explode(_seq1(F.size("terms"))).alias("depth"))
    return x.select("request_id", "depth",
                    (F.lit(1 - p) * _fold_sum(F.slice("terms", 1, F.col("depth")))).alias("rbo"))


@_on_lists
def rbo(lists: DataFrame, p: float = RBO_P) -> DataFrame:
    """Truncated rank-biased overlap at depth min(len_a, len_b) (0 when a list is empty)."""
    return lists.select("request_id", (F.lit(1 - p) * _fold_sum(_rbo_terms(p))).alias("rbo"))


@_on_lists
def position_match(lists: DataFrame, p: float = RBO_P) -> DataFrame:
    """E5: sum over 0-based positions i < min(len) of p^i when both lists hold the same id at i."""
    same = F.filter(_seq1(_shorter()), lambda d: F.get("a", d - 1) == F.get("b", d - 1))
    return lists.select("request_id", _fold_sum(F.transform(same, lambda d: _power(p, d - 1))).alias("position_match"))


@_on_lists
def match_matrix(lists: DataFrame) -> DataFrame:
    """0/1 matrix over (position in a, position in b); size bounded by the list lengths."""
    x = lists.select("request_id", "b", F.posexplode("a").alias("i", "x"))
    x = x.select("request_id", "i", "x", F.posexplode("b").alias("j", "y"))
    return x.select("request_id", (F.col("i") + 1).alias("i"), (F.col("j") + 1).alias("j"),
                    (F.col("x") == F.col("y")).cast("int").alias("match"))
