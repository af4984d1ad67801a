from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marquee.llm import signatures
from marquee.llm.signatures import COORDINATES, SignatureJoin, match_threshold
from marquee.llm.words import shingle_sets
from tests.llm.test_jaccard_join import LOWER, WORD, planted


def slow(rows, n=5, percent=85):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    component = [least.get(top(i)) if sets[i] else d for i, (d, _) in enumerate(rows)]
    return Counter((d, len(sets[i]), component[i], d == component[i]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("hot, filter_bits", [(100_000, 1 << 26), (3, 64)])
def test_components_against_all_pairs(spark, hot, filter_bits, monkeypatch):
    monkeypatch.setattr(signatures, "HOT", hot)  # 3: most classes with pairs are salted
    monkeypatch.setattr(signatures, "FILTER_BITS", filter_bits)  # 64: the filter lets nearly every row through
    rows = planted(4, base_size=120, copies=50)
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n int, class string, kept int").repartition(4)
    expected = slow(rows)
    assert len({c for _, _, c, _ in expected}) < len(rows) - 60  # some link
    assert Counter(tuple(r) for r in SignatureJoin(docs).documents().collect()) == expected


def test_repeated_ids_missing_values_and_given_documents(hard_docs, some_docs):
    docs = hard_docs.select("doc_id", "text", "hash", "class").unionByName(some_docs.selectExpr("doc_id", "text", "'h' AS hash", "2 AS class"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter(tuple(r) for r in SignatureJoin(docs).documents().collect()) == slow(rows)


def test_empty(no_docs):
    assert SignatureJoin(no_docs).documents().collect() == []


def test_collisions_follow_the_similarity():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(100_000)]
    base = [words[i] for i in rng.integers(0, len(words), 400)]
    for cut, expected in ((40, 0.9), (100, 0.75), (200, 0.5)):
        texts = [" ".join(base), " ".join(base[cut:])]
        gram, bounds = shingle_sets(pa.array(texts), 1)
        both = signatures.signatures(gram, bounds)
        assert abs((both[0] == both[1]).mean() - expected) < 4 * (expected * (1 - expected) / COORDINATES) ** 0.5


def test_threshold():
    assert match_threshold(100) == COORDINATES
    t = match_threshold(85)
    rng = np.random.default_rng(0)
    assert 64 < t < 100 and rng.binomial(COORDINATES, 0.85, 1_000_000).min() >= t


def test_parities_differ_in_no_more_bins_than_sets_have_own_members():
    texts = [" ".join(f"w{i}" for i in range(a, b)) for a, b in ((0, 300), (20, 310), (0, 300), (500, 900))]
    gram, bounds = shingle_sets(pa.array(texts), 1)
    odd = np.unpackbits(signatures.parities(gram, bounds).view(np.uint8), axis=1)
    sets = [set(gram[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
    for i in range(4):
        for j in range(4):
            apart = len(sets[i] ^ sets[j])
            assert apart // 2 <= (odd[i] != odd[j]).sum() <= apart or apart > 100


def test_sets_are_read_for_the_classes_of_pairs_alone(spark):
    rows = planted(4, base_size=120, copies=20)
    join = SignatureJoin(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    some = [r["class"] for r in join.classes.orderBy("class").limit(6).collect()]
    pairs = spark.createDataFrame(list(zip(some[::2], some[1::2])), "a long, b long")
    sizes = {r["class"]: r["n_shingles"] for r in join.rows.collect()}
    assert {r["class"]: len(r["grams"]) // 8 for r in join._sets_of(pairs).collect()} == {c: sizes[c] for c in some}
    assert join._sets_of(pairs.limit(0)).collect() == []


def test_filter_holds_its_keys_and_few_others(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) AS key")
    words = SignatureJoin._filter(None, keys)
    others = spark.range(3000, 9000).selectExpr("xxhash64(id) AS key")
    held, wrong = (signatures._held(words, t.toArrow()["key"].combine_chunks()) for t in (keys, others))
    assert held.all() and wrong.mean() < 0.02
    assert not signatures._held(SignatureJoin._filter(None, keys.limit(0)), keys.toArrow()["key"].combine_chunks()).any()
