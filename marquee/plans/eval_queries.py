"""Registered list-comparison queries (E1-E7, W8) over two ranked lists per user.

List a: the user's items by summed rating (ties: id); list b: the user's items by
global mean rating (ties: id); both cut at 10. Every user is one request.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import evaluation as E
from marquee.operators import relational as Rel
from marquee.plans.catalog import register
from marquee.sources import fixtures as fx

V = fx.with_views
N = 10


def lists(spark, sf_dir):
    """Both lists of every user, paired. One summed matrix feeds the item means (sums and counts of half
    stars are exact) and both rankings, so the facts are scanned for one shuffle only."""
    im = fx.ratings(spark, sf_dir).groupBy("userId", "movieId").agg(
        F.sum("rating").alias("rating"), F.count("rating").alias("votes"))
    pop = im.groupBy("movieId").agg((F.sum("rating") / F.sum("votes")).alias("ave_rating"))
    both = im.join(pop, "movieId")
    per = [Rel.top_k_per_group(both, ["userId"], [F.col(c).desc(), F.col("movieId").asc()], N).select(
        F.col("userId").alias("request_id"), "rank", F.col("movieId").alias("movie_id")) for c in ("rating", "ave_rating")]
    return E.paired(*per)


_LISTS = f"""{V('ratings')},
im AS (SELECT userId, movieId, sum(rating) AS r FROM ratings GROUP BY userId, movieId),
pop AS (SELECT movieId, avg(rating) AS ave FROM ratings GROUP BY movieId),
la AS (SELECT * FROM (SELECT userId AS request_id, movieId AS movie_id,
                      row_number() OVER (PARTITION BY userId ORDER BY r DESC, movieId) AS rank FROM im) WHERE rank <= {N}),
lb AS (SELECT * FROM (SELECT im.userId AS request_id, im.movieId AS movie_id,
                      row_number() OVER (PARTITION BY im.userId ORDER BY pop.ave DESC, im.movieId) AS rank
                      FROM im JOIN pop ON im.movieId = pop.movieId) WHERE rank <= {N}),
lens AS (SELECT la.request_id, max(la.rank) AS len_a, (SELECT max(rank) FROM lb WHERE lb.request_id = la.request_id) AS len_b
         FROM la GROUP BY la.request_id),
cm AS (SELECT la.request_id, la.movie_id, la.rank AS ra, lb.rank AS rb FROM la JOIN lb
       ON la.request_id = lb.request_id AND la.movie_id = lb.movie_id)"""

PW = "list_reduce(list_prepend(CAST(1 AS DOUBLE), list_transform(range({e}), lambda i: CAST(0.9 AS DOUBLE))), lambda x, y: x * y)"
FOLD = "list_reduce(list_prepend(CAST(0 AS DOUBLE), {l}), lambda x, y: x + y)"
OMP = "(CAST(1 AS DOUBLE) - CAST(0.9 AS DOUBLE))"
_TERMS = ("tm AS (SELECT request_id, depth, (overlap / depth) * " + PW.format(e="depth - 1") + " AS t FROM ov),\n"
          "ag AS (SELECT request_id, list(t ORDER BY depth) AS terms FROM tm GROUP BY request_id)")

_OVERLAP = """dp AS (SELECT request_id, unnest(range(1, CAST({top} AS BIGINT) + 1)) AS d FROM lens),
ov AS (SELECT dp.request_id, dp.d AS depth,
              (SELECT count(*) FROM cm WHERE cm.request_id = dp.request_id AND greatest(cm.ra, cm.rb) <= dp.d) AS overlap
       FROM dp)"""


@register(
    "eval_precision",
    f"""{_LISTS} SELECT l.request_id, coalesce((SELECT count(*) FROM cm WHERE cm.request_id = l.request_id AND ra <= 5 AND rb <= 5), 0) / 5 AS precision_at_k FROM lens l""",
)
def eval_precision(spark, sf_dir):
    """precision@5."""
    return E.precision_at_k(lists(spark, sf_dir), k=5)


@register(
    "eval_jaccard",
    f"""{_LISTS} SELECT l.request_id, (SELECT count(*) FROM cm WHERE cm.request_id = l.request_id) /
   (SELECT count(*) FROM (SELECT movie_id FROM la WHERE la.request_id = l.request_id UNION SELECT movie_id FROM lb WHERE lb.request_id = l.request_id)) AS jaccard
FROM lens l""",
)
def eval_jaccard(spark, sf_dir):
    """E2."""
    return E.jaccard(lists(spark, sf_dir))


@register(
    "eval_intersect",
    f"{_LISTS} SELECT l.request_id, CAST((SELECT count(*) FROM cm WHERE cm.request_id = l.request_id) AS BIGINT) AS intersection FROM lens l",
)
def eval_intersect(spark, sf_dir):
    """E3."""
    return E.intersection_size(lists(spark, sf_dir))


@register(
    "eval_rbo",
    f"""{_LISTS}, {_OVERLAP.format(top='least(len_a, len_b)')}, {_TERMS}
SELECT l.request_id, {OMP} * coalesce({FOLD.format(l='ag.terms')}, CAST(0 AS DOUBLE)) AS rbo
FROM lens l LEFT JOIN ag ON l.request_id = ag.request_id""",
    headline=True,
)
def eval_rbo(spark, sf_dir):
    """Truncated RBO, p = 0.9 (the measure the reference reports)."""
    return E.rbo(lists(spark, sf_dir))


@register(
    "eval_rbo_curve",
    f"""{_LISTS}, {_OVERLAP.format(top='least(len_a, len_b)')}, {_TERMS},
ks AS (SELECT request_id, terms, unnest(range(1, len(terms) + 1)) AS k FROM ag)
SELECT request_id, CAST(k AS INTEGER) AS depth, {OMP} * {FOLD.format(l='terms[1:k]')} AS rbo FROM ks""",
)
def eval_rbo_curve(spark, sf_dir):
    """E4b."""
    return E.rbo_curve(lists(spark, sf_dir))


@register(
    "topn_overlap_curve",
    f"""{_LISTS}, {_OVERLAP.format(top=N)}
SELECT request_id, CAST(depth AS INTEGER) AS depth, CAST(overlap AS BIGINT) AS overlap FROM ov""",
)
def topn_overlap_curve(spark, sf_dir):
    """Overlap at depths 1..10."""
    return E.overlap_curve(lists(spark, sf_dir), depth=N)


@register(
    "eval_position_match",
    f"""{_LISTS},
pm AS (SELECT request_id, list({PW.format(e='ra - 1')} ORDER BY ra) AS t FROM cm WHERE ra = rb GROUP BY request_id)
SELECT l.request_id, coalesce({FOLD.format(l='pm.t')}, CAST(0 AS DOUBLE)) AS position_match
FROM lens l LEFT JOIN pm ON l.request_id = pm.request_id""",
)
def eval_position_match(spark, sf_dir):
    """E5."""
    return E.position_match(lists(spark, sf_dir))


@register(
    "eval_match_matrix",
    f"""{_LISTS},
cells AS (SELECT request_id, unnest(range(1, len_a + 1)) AS i, len_b FROM lens),
cells2 AS (SELECT request_id, i, unnest(range(1, len_b + 1)) AS j FROM cells)
SELECT c.request_id, CAST(c.i AS INTEGER) AS i, CAST(c.j AS INTEGER) AS j,
       CASE WHEN EXISTS (SELECT 1 FROM cm WHERE cm.request_id = c.request_id AND cm.ra = c.i AND cm.rb = c.j) THEN 1 ELSE 0 END AS match
FROM cells2 c""",
)
def eval_match_matrix(spark, sf_dir):
    """E7."""
    return E.match_matrix(lists(spark, sf_dir))
