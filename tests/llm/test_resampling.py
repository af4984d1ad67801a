import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest

from marquee.llm.resampling import features, resample, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, n):
    found = WORD.findall((text or "").translate(LOWER))
    return found, [" ".join(found[i : i + k]) for k in range(1, n + 1) for i in range(len(found) - k + 1)]


def slow(rows, target, n, buckets, least, percent):
    def counts(texts):
        return Counter(crc32(g.encode()) % buckets for t in texts for g in runs(t, n)[1])

    s, t = counts(x for _, x in rows), counts(target)
    S, T = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in s}
    out = []
    for i, text in rows:
        found, grams = runs(text, n)
        weight = sum(gain[crc32(g.encode()) % buckets] for g in grams)
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((len(found), i, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    some = sorted((r for r in out if r[0] >= least), key=lambda r: (-r[4], r[1] is not None, r[1] or 0))
    drawn = some[: percent * len(some) // 100]
    rest = Counter(out) - Counter(drawn)
    return Counter((*r[1:], k + 1) for k, r in enumerate(drawn)) + Counter((*r[1:], None) for r in rest.elements())


@pytest.mark.parametrize("n,buckets,least,percent", [(1, 10_000, 20, 10), (2, 50, 1, 60), (3, 1, 0, 100)])
def test_against_the_definition(spark, hard_docs, some_docs, n, buckets, least, percent):
    docs = hard_docs.select("doc_id", "text", "weight", "n_tokens").unionByName(some_docs.selectExpr("doc_id + 100 AS doc_id", "text", "null AS weight", "1 AS n_tokens"))
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").unionByName(spark.createDataFrame([(1, None), (2, "")], "item_id long, text string"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = resample(docs, target, n, buckets, least, percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == slow(rows, [r["text"] for r in target.collect()], n, buckets, least, percent)


def test_features_are_whole_runs():
    text = "Don't stop-it ÄÖ 你好 a1_B2\x00c\x7fd ²³ é́x"
    assert [w.decode() for w in words(text)] == WORD.findall(text.translate(LOWER))
    for n in (1, 2, 4):
        assert features(words(text), n, 1 << 32) == Counter(crc32(g.encode()) for g in runs(text, n)[1])


def test_empty_tables_and_repeated_rows(spark, no_docs):
    target = spark.createDataFrame([("a b c",)], "text string")
    assert resample(no_docs, target).collect() == []
    same = spark.createDataFrame([(1, "w " * 30)] * 40, "doc_id long, text string").repartition(4)
    got = resample(same, target.limit(0)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4] and len({r["score"] for r in got}) == 1 and len(got) == 40
