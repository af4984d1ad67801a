"""Joins whose heavy keys are cut into parts, and the co-rating product on them."""

from collections import Counter

import pytest

from marquee.operators import relational as Rel
from marquee.operators import users as U


def test_equal_to_a_plain_join(spark):
    left = spark.createDataFrame([(i % 3, f"l{i}") for i in range(7)] + [(None, "n"), (9, "x")], "key long, a string")
    right = spark.createDataFrame([(0, i) for i in range(60)] + [(1, 5), (2, 6), (2, 6), (None, 1), (7, 7)], "key long, b long").repartition(3)
    plain = Counter(map(tuple, left.join(right, "key").select("key", "a", "b").collect()))
    for limit in (1, 7, 1000):
        got = Rel.split_join(left, right, "key", "b", limit)
        assert got.columns == ["key", "a", "b"]
        assert Counter(map(tuple, got.collect())) == plain


@pytest.mark.parametrize("heavy", [2, 100_000])
def test_co_rating_product(spark, heavy, monkeypatch):
    monkeypatch.setattr(Rel, "HEAVY", heavy)  # 2: most items and users are cut into parts
    cells = {(u, i): float(1 + (u * i) % 4) for u in range(9) for i in range(12) if (u + i) % 3 or i == 0}
    cells |= {(20, 100): 2.0}  # a user whom nobody co-rates
    ratings = spark.createDataFrame([(u, i, r) for (u, i), r in cells.items()] + [(1, 0, 1.0)], "userId long, movieId long, rating double")
    cells[1, 0] += 1.0  # repeated cells add up
    items, users = sorted({i for _, i in cells}), sorted({u for u, _ in cells})
    peers = spark.createDataFrame([(u,) for u in (0, 4, 20)], "peer_id long")
    expected = set()
    for u in (0, 4, 20):
        dots = {v: sum(cells.get((u, i), 0) * cells.get((v, i), 0) for i in items) for v in users}
        scores = {j: sum(dots[v] * cells.get((v, j), 0) for v in users) for j in items if (u, j) not in cells}
        best = sorted(scores, key=lambda j: (-scores[j], j))[:5]
        expected |= {(u, j, scores[j], k + 1) for k, j in enumerate(best)}
    got = U.co_rating_scores(peers, ratings, 5).select("peer_id", "movieId", "score", "item_rank")
    assert {tuple(r) for r in got.collect()} == expected
