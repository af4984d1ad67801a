"""Quantiles per group over ranges: equal to numpy's, whatever the sizes of the groups."""

import numpy as np
import pytest

from marquee.operators.relational import group_quantile


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.6, 1.0])
def test_group_quantile(spark, p):
    rng = np.random.default_rng(3)
    rows = [("hot", int(v)) for v in rng.integers(0, 900, 3000)] + [("ties", 4)] * 50 + [("one", 7)]
    rows += [("two", 1), ("two", 2), ("null", None), ("two", None), (None, 5)]
    df = spark.createDataFrame(rows, "g string, x long").repartition(7)
    got = {r.g: r.q for r in group_quantile(df, ["g"], "x", p, "q").collect()}
    want = {g: np.quantile([x for k, x in rows if k == g and x is not None], p) for g in ("hot", "ties", "one", "two")}
    assert set(got) == set(want)
    for g, q in want.items():
        assert got[g] == pytest.approx(q, abs=1e-9)


def test_group_quantile_of_two_keys_and_of_nothing(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 1, 4.0), (1, 2, 9.0)], "a int, b int, x double")
    assert sorted(tuple(r) for r in group_quantile(df, ["a", "b"], "x", 0.5, "q").collect()) == [(1, 1, 3.0), (1, 2, 9.0)]
    assert group_quantile(df.where("a = 7"), ["a", "b"], "x", 0.5, "q").count() == 0
