"""Structured Streaming popularity: equals the batch aggregate, and a restart from the same
checkpoint replays nothing (idempotent sink)."""

import os

import pytest

from marquee.operators import clustering as Cl
from marquee.operators import models as M
from marquee.operators import relational as Rel
from marquee.sources import fixtures as fx
from marquee.sources.batches import BatchTable
from marquee.sources.io import shared_path
from marquee.streaming import fold_in_stream as F
from marquee.streaming import ratings_stream as S
from tests.conftest import SF_SMALL


def test_stream_matches_batch_and_restarts_cleanly(spark):
    out = shared_path(spark, "test-stream-out")
    ckpt = shared_path(spark, "test-stream-ckpt")
    S.run_popularity_stream(spark, SF_SMALL, out, ckpt)
    first = {r.movieId: (r.ave_rating, r.rating_count) for r in S.latest_popularity(spark, out).collect()}
    batch = {r.movieId: (r.ave_rating, r.rating_count) for r in Rel.popularity(fx.ratings(spark, SF_SMALL)).collect()}
    assert first == batch
    batches = sorted(p for p in os.listdir(out.replace("file:", "")) if p.startswith("batch="))
    S.run_popularity_stream(spark, SF_SMALL, out, ckpt)  # restart: nothing new to read
    again = {r.movieId: (r.ave_rating, r.rating_count) for r in S.latest_popularity(spark, out).collect()}
    assert again == first
    assert sorted(p for p in os.listdir(out.replace("file:", "")) if p.startswith("batch=")) == batches


def test_several_batches_merge_by_key(spark, tmp_path):
    import pyarrow.parquet as pq

    lines = pq.read_table(f"{SF_SMALL}/lineitem.parquet")
    cuts = [0, 10, 1500, 4000, lines.num_rows]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        pq.write_table(lines.slice(a, b - a), tmp_path / ("lineitem.parquet" if i == 0 else f"lineitem_{i}.parquet"))
    pq.write_table(pq.read_table(f"{SF_SMALL}/orders.parquet"), tmp_path / "orders.parquet")
    out = S.run_popularity_stream(spark, str(tmp_path))
    assert len([p for p in os.listdir(out.replace("file:", "")) if p.startswith("batch=")]) == 4
    got = {r.movieId: (r.ave_rating, r.rating_count) for r in S.latest_popularity(spark, out).collect()}
    assert got == {r.movieId: (r.ave_rating, r.rating_count) for r in Rel.popularity(fx.ratings(spark, SF_SMALL)).collect()}


def _model(spark, folder, d=3):
    factors = [(m, [float((m * 7 + k * 3) % 5 - 2) + 0.25 * k for k in range(d)]) for m in range(1, 41)]
    cents = [(c, [float(c == k) for k in range(d)]) for c in range(d)]
    F.write_model(folder, 1, spark.createDataFrame(factors, "id long, vec array<double>"),
                  spark.createDataFrame(cents, "cluster int, centroid array<double>"))
    return F.read_model(spark, folder, 1)


def _batch(ratings, factors, cents):
    vec = M.fold_in_users(ratings, factors, 0.1)
    return {r.id: (r.assigned, r.vec) for r in vec.join(Cl.assign_centroid(vec, cents), "id").collect()}


def _assert_same(table, want, counts):
    got = {r.id: r for r in table.read().collect()}
    assert set(got) == set(want)
    for i, (cluster, vec) in want.items():
        assert got[i].cluster == cluster and got[i].n_ratings == counts[i]
        assert max(abs(a - b) for a, b in zip(got[i].vec, vec)) < 1e-9


ROUNDS = [
    [(1, 1, 4.0), (1, 2, 2.5), (2, 3, 5.0), (2**40, 5, 1.0)] + [(7, m, (m % 9) / 2) for m in range(1, 31)],  # 7: sums in one row
    [(1, 3, 0.5), (3, 9, 3.0), (1, 999, 5.0), (None, 1, 2.0), (4, 1, None)] + [(7, m, 1.5) for m in range(20, 41)],
    [(2, 3, 5.0), (1, 4, 3.5)],  # a repeated rating counts again, as in the batch form
]
SCHEMA = "userId long, movieId long, rating double"


def _arrive(spark, source, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(source)
    return spark.readStream.schema(SCHEMA).parquet(source)


def test_arriving_users_equal_the_batch_fold_in(spark):
    folder, source, out, ckpt = (shared_path(spark, f"t-fold-{n}") for n in ("model", "source", "out", "ckpt"))
    factors, cents = _model(spark, folder)
    seen = []
    for rows in ROUNDS:
        table = F.run_fold_in_stream(_arrive(spark, source, rows), folder, 1, out, ckpt)
        seen += [r for r in rows if r[0] is not None and r[2] is not None and r[1] <= 40]
        counts = {u: sum(r[0] == u for r in seen) for u in {r[0] for r in seen}}
        _assert_same(table, _batch(spark.createDataFrame(seen, SCHEMA), factors, cents), counts)
    before = sorted(tuple(r) for r in table.log().collect())
    again = F.run_fold_in_stream(spark.readStream.schema(SCHEMA).parquet(source), folder, 1, out, ckpt)  # nothing new
    assert sorted(tuple(r) for r in again.log().collect()) == before


def test_killed_batch_is_counted_once(spark, monkeypatch):
    folder, source, out, ckpt = (shared_path(spark, f"t-kill-{n}") for n in ("model", "source", "out", "ckpt"))
    factors, cents = _model(spark, folder)
    F.run_fold_in_stream(_arrive(spark, source, ROUNDS[0]), folder, 1, out, ckpt)
    commit = BatchTable._commit

    def killed(self, batch, *args):
        raise RuntimeError("killed before the log has the batch")

    stream = _arrive(spark, source, ROUNDS[2])
    monkeypatch.setattr(BatchTable, "_commit", killed)
    with pytest.raises(Exception, match="killed"):
        F.run_fold_in_stream(stream, folder, 1, out, ckpt)
    assert F.placements(spark, out, 1).log().count() == 1
    monkeypatch.setattr(BatchTable, "_commit", commit)
    table = F.run_fold_in_stream(stream, folder, 1, out, ckpt)
    seen = ROUNDS[0] + ROUNDS[2]
    counts = {u: sum(r[0] == u for r in seen) for u in {r[0] for r in seen}}
    _assert_same(table, _batch(spark.createDataFrame(seen, SCHEMA), factors, cents), counts)


def test_arriving_items_against_user_factors(spark):
    folder, source, out, ckpt = (shared_path(spark, f"t-items-{n}") for n in ("model", "source", "out", "ckpt"))
    factors, cents = _model(spark, folder)
    rows = [(u, 500 + u % 3, u / 10) for u in range(1, 30)]
    table = F.run_fold_in_stream(_arrive(spark, source, rows), folder, 1, out, ckpt, entity="movieId", other="userId")
    swapped = spark.createDataFrame([(m, u, r) for u, m, r in rows], SCHEMA)
    counts = {500 + k: sum(r[1] == 500 + k for r in rows) for k in range(3)}
    _assert_same(table, _batch(swapped, factors, cents), counts)


def test_sums_of_hot_users_are_bytes():
    import numpy as np
    import pandas as pd

    from marquee.streaming import fold_in_stream as Fold

    f, r = np.arange(12.0).reshape(6, 2), np.arange(6.0)
    out = list(Fold._collapse(iter([pd.DataFrame({"id": [1] * 6, "f": list(f), "rating": r})])))
    assert len(out) == 1 and isinstance(out[0]["sums"][0], bytes)
    assert np.array_equal(np.frombuffer(out[0]["sums"][0]), Fold._sums(f, r))


def test_state_and_shuffle_hold_ratings_where_sums_are_larger(spark):
    """64 factors make 17 KB of sums; a user with few ratings has 16 bytes for each, and no factors are shuffled."""
    import numpy as np
    import pandas as pd

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    rng = np.random.default_rng(4)
    big = 2**60
    vecs = {big + i: rng.normal(size=64) for i in range(3000)}
    side = F._positions(spark.createDataFrame([(i, v.tolist()) for i, v in vecs.items()], "id long, vec array<double>"), 3)
    rounds = [[(big + 1, 4.0), (big + 2, 1.0), (7, 5.0)], [(big + 2, 2.0), (big + 9, 3.0)]]
    hot = [[(i, float(i % 9)) for i in list(vecs)[:1500]], [(big + 2999, 1.0)]]
    for arriving, n in ((rounds, [2, 4]), (hot, [1500, 1501])):
        state, seen = State(), []
        for rows, count in zip(arriving, n):
            pdf = pd.DataFrame({"id": 5, "other": [i for i, _ in rows], "rating": [r for _, r in rows]})
            chunks = list(F._gathered(side)(iter([pdf])))
            assert all(list(c.columns) == ["id", "other", "rating", "sums"] for c in chunks)
            assert sum(len(c) for c in chunks) == (1 if len(rows) > 1000 else len(rows) - (rows[-1][0] == 7))
            out = list(F._fold(0.1, side)((5,), iter([pd.concat(chunks)]), state))[0]
            seen += [r for r in rows if r[0] in vecs]
            v, y = np.array([vecs[i] for i, _ in seen]), np.array([r for _, r in seen])
            assert out["n_ratings"][0] == count == len(seen)
            assert np.allclose(out["vec"][0], np.linalg.solve(v.T @ v + 0.1 * len(seen) * np.eye(64), v.T @ y))
            kept, sums = state.get
            assert (kept is None) != (sums is None) and len(kept or sums) == min(16 * len(seen), F._sum_bytes(64))
    side.discard()


def test_positions_find_ids_once_for_each(spark):
    import numpy as np

    rows = [(3, [1.0, 2.0]), (5, [3.0, 4.0]), (5, [5.0, 6.0]), (2**60 + 1, [7.0, 8.0]), (None, [0.0, 0.0])]
    side = F._positions(spark.createDataFrame(rows, "id long, vec array<double>"), 2)
    at, f = F.als._Lookup(side).find(np.array([5, 1, 2**60 + 1, 2**60, 3, 5]))
    assert at.tolist() == [0, 0, 2, 4, 5, 5]
    assert sorted(f[:2].tolist()) == sorted(f[4:].tolist()) == [[3.0, 4.0], [5.0, 6.0]] and f[2:4].tolist() == [[7.0, 8.0], [1.0, 2.0]]
    side.discard()
