import random
import re
from collections import Counter

import pytest

from marquee.llm.components import components
from marquee.llm.jaccard_join import JaccardJoin, keep_first

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                    parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return Counter((d, len(sets[i]), least.get(top(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


def planted(seed, base_size=60, copies=60, singles=30):
    """Groups of copies with 0 to 5 edits (so some pairs of a group link and others don't), a shared passage, and singles."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = " ".join(rng.choices(words, k=40))
    texts = []
    for size in (base_size, 150, 8, 3):
        base = rng.choices(words, k=size)
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randrange(0, 6)):
                what = rng.random()
                at = rng.randrange(len(t))
                if what < 0.6:
                    t[at] = rng.choice(words)
                elif what < 0.8:
                    t.insert(at, rng.choice(words))
                elif len(t) > 3:
                    del t[at]
            texts.append(" ".join(t))
    texts += [passage + " " + " ".join(rng.choices(words, k=rng.randrange(0, 30))) for _ in range(singles)]
    texts += [passage, passage.upper(), "", None, "a b", "A  b", "b a", "a", "a"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", range(3))
def test_components_against_all_pairs(spark, seed):
    rows = planted(seed)
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n int, class string, component_id int").repartition(4)
    assert Counter(tuple(r) for r in JaccardJoin(docs).documents().collect()) == slow(rows)


def test_repeated_ids_and_missing_values(spark, hard_docs):
    rows = [(r["doc_id"], r["text"]) for r in hard_docs.collect()]
    assert Counter(tuple(r) for r in JaccardJoin(hard_docs).documents().collect()) == slow(rows)
    kept = keep_first(hard_docs)
    assert kept.columns == hard_docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[6] == 1 and 7 not in ids and ids[0] == ids[1] == 1


def test_rows_with_equal_ids_stay_unless_they_link(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    docs = spark.createDataFrame([(3, x), (5, x), (5, y), (5, y), (7, z), (7, ""), (7, ""), (None, z)], "doc_id long, text string")
    assert Counter(map(tuple, keep_first(docs).collect())) == Counter([(3, x), (5, y), (7, ""), (7, ""), (None, z)])


def test_given_documents(some_docs):
    rows = [(r["doc_id"], r["text"]) for r in some_docs.collect()]
    expected = slow(rows)
    assert Counter(tuple(r) for r in JaccardJoin(some_docs).documents().collect()) == expected
    assert sorted(r["doc_id"] for r in keep_first(some_docs).collect()) == sorted(d for d, n, c in expected if d == c)


def test_empty(no_docs):
    assert JaccardJoin(no_docs).documents().collect() == []


def test_components_of_paths(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}
