import hashlib
from collections import Counter

import numpy as np
import pytest

import marquee.llm.syncmers as m
from marquee.llm.words import mix


def slow_anchors(text):
    """Windows whose smallest inner substring is at an edge, one by one."""
    x = [int(v) for v in mix(m.code_points(text).astype(np.uint64) + np.uint64(1))]
    mask, step = (1 << 64) - 1, int(m._STEP)

    def value(part):
        out = 0
        for v in part:
            out = (out * step + v) & mask
        return out

    def shuffled(v):
        return int(mix(np.array([v], np.uint64))[0])

    out = []
    for i in range(len(x) - m.K + 1):
        inner = [shuffled(value(x[i + j : i + j + m.S])) for j in range(m.WINDOW)]
        if min(inner) in (inner[0], inner[-1]):
            key = value(x[i + m.K - m.S : i + m.K])
            for j in range(0, m.K - m.S, m.S):
                key = (key * step + value(x[i + j : i + j + m.S])) & mask
            v = shuffled(key) >> 40
            if v not in out:
                out.append(v)
    return out


@pytest.mark.parametrize("text", ["The quick brown fox jumps over the lazy dog, " * 2 + "and then some ñandú 你好🙂 more", "ab" * 60, "x" * 39])
def test_anchors(text):
    assert m.anchors(m.code_points(text)).tolist() == slow_anchors(text)


def lcs(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        old = best[:]
        for j, y in enumerate(b):
            best[j + 1] = old[j] + 1 if x == y else max(best[j], old[j + 1])
    return best[-1]


def test_likeness():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (rng.permutation(30)[: rng.integers(1, 30)].astype(np.uint32) for _ in range(2))
        assert m.likeness(a, b) == (1.0 if a.tolist() == b.tolist() else 2 * lcs(a.tolist(), b.tolist()) / (len(a) + len(b)))


@pytest.mark.parametrize("size", [8 << 20, 3000])
@pytest.mark.parametrize("name", ["hard_docs", "some_docs"])
def test_neighbours(name, size, request, monkeypatch):
    monkeypatch.setattr(m, "RANGE_BYTES", size)
    docs = request.getfixturevalue(name)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = Counter()
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        k = len(t) // 3
        e = t[: len(t) - k] + u[:k]
        a, b, c = (m.anchors(m.code_points(x)) for x in (t, e, u))
        expected[(i, len(t), hashlib.sha256(e.encode()).hexdigest(), m.fingerprint(a), m.fingerprint(b), m.likeness(a, b), m.likeness(a, c))] += 1
    assert Counter(tuple(r) for r in m.edited_neighbours(docs).collect()) == expected


def test_edited_text_is_near(some_docs):
    rows = [r for r in m.edited_neighbours(some_docs).collect() if r["n_chars"] > 300]
    near = [r["near_edited"] for r in rows]
    assert np.median(near) > 0.55 and np.median([r["near_next"] for r in rows]) < 0.05


def test_one_and_none(spark, no_docs):
    one = m.edited_neighbours(spark.createDataFrame([(1, "abc" * 40)], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert m.edited_neighbours(no_docs).collect() == []


def test_short_edited_text_is_near(spark):
    """Texts of 20 to 300 code points, whose last third is another text's."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(text) BETWEEN 20 AND 300")
    rows = m.edited_neighbours(docs).collect()
    for low, high, least in ((20, 57, 0.2), (57, 100, 0.4), (100, 301, 0.5)):
        here = [r for r in rows if low <= r["n_chars"] < high]
        assert here and np.median([r["near_edited"] for r in here]) > least
        assert np.median([r["near_next"] for r in here]) < 0.1


def test_scales():
    a, b = (m.anchors(m.code_points(t)) for t in ("a short text of a few common words", "a short text of a few other things"))
    assert m.likeness(a, a) == 1.0 and 0.2 < m.likeness(a, b) < 1 and "." in m.fingerprint(a)
    assert m.anchors(m.code_points("")).fine is None and m.fingerprint(m.anchors(m.code_points(""))) == ""
