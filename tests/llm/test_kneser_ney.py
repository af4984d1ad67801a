import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from marquee.llm import kneser_ney as kn

N = kn.ORDER


def padded(text):
    return [kn.START] * (N - 1) + [ord(c) for c in text or ""] + [kn.END]


def slow_model(texts):
    """Interpolated modified Kneser-Ney from its definition; returns log p(w | context)."""
    counts = {N: Counter()}
    for t in texts:
        p = padded(t)
        counts[N].update(tuple(p[i : i + N]) for i in range(len(p) - N + 1))
    for n in range(N - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cuts, sums, takes = {}, defaultdict(int), defaultdict(float)
    for n, table in counts.items():
        c = Counter(table.values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0.0
        cuts[n] = [min(max(i - (i + 1) * y * c[i + 1] / c[i], 0.0), i) if c[i] else 0.5 for i in (1, 2, 3)]
        for g, k in table.items():
            sums[g[:-1]] += k
            takes[g[:-1]] += min(cuts[n][min(k, 3) - 1], k)

    def p(g):
        if not g:
            return 1 / (len(counts[1]) + 1)
        if g[:-1] not in sums:
            return p(g[1:])
        k = counts[len(g)][g]
        own = max(k - cuts[len(g)][min(k, 3) - 1], 0) if k else 0
        return own / sums[g[:-1]] + takes[g[:-1]] / sums[g[:-1]] * p(g[1:])

    return lambda text: sum(-math.log(p(tuple(x[i : i + N]))) for x in [padded(text)] for i in range(len(x) - N + 1))


TRAIN = ["the cat sat on the mat", "the dog sat on the log", "añb 你好 the end", "aaaa bbbb aaaa", "", "the the the cat"]
TEST = ["the cat on the log", "zzz qqq", "", None, "añb", "x", "你 the 🙂", "THE CAT!!"]


@pytest.mark.parametrize("direct", [kn.DIRECT, 4])
def test_grams(direct, monkeypatch):
    monkeypatch.setattr(kn, "DIRECT", direct)
    grams = kn.Grams(pa.array(TEST))
    found = [tuple(g) for g in grams.distinct.tolist()]
    expected = [tuple(p[i : i + N]) for p in map(padded, TEST) for i in range(len(p) - N + 1)]
    assert [found[c] for c in grams.code] == expected and len(set(found)) == len(found)
    assert grams.row_sums(np.ones(len(found))).tolist() == grams.sizes.tolist() == [len(t or "") + 1 for t in TEST]


def test_losses_against_the_definition(spark, monkeypatch):
    monkeypatch.setattr(kn, "BLOCK_BYTES", 20)
    model = kn.Model(spark.createDataFrame([(t,) for t in TRAIN], "text string"))
    docs = spark.createDataFrame(list(enumerate(TEST)), "doc_id long, text string")
    slow = slow_model(TRAIN)
    for r in kn.scores(docs, model).collect():
        assert r["length"] == len(TEST[r["doc_id"]] or "") + 1
        assert math.isclose(r["loss"], slow(TEST[r["doc_id"]]), rel_tol=1e-9)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    odd = labels.where("doc_id % 2 = 1")
    judged = {r["doc_id"]: r["kept"] for r in kn.classify(docs, odd).collect()}
    even = [(r["quality"], judged[r["doc_id"]]) for r in labels.where("doc_id % 2 = 0").collect()]
    good = [k for q, k in even if q == 1]
    bad = [k for q, k in even if q == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.6


def test_missing_values(spark, hard_docs, no_docs):
    labels = spark.createDataFrame([(2, 1, 0), (6, 1, None), (13, 1, 0), (4, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    judged = kn.classify(hard_docs, labels)
    assert judged.count() == hard_docs.count()
    kept = kn.filter_documents(hard_docs, labels)
    assert kept.columns == hard_docs.columns and kept.count() == judged.where("kept").count()
    none = labels.limit(0)
    assert kn.classify(hard_docs, none).where("kept").count() == hard_docs.count()
    assert kn.classify(no_docs, labels).collect() == []


def test_limits_by_language_and_length(spark):
    """Short texts scatter more, by what was held out and not by a formula; rare languages have the scatter of all."""
    lengths = {"a": (60, 0.4), "b": (2000, 0.02)}
    rows, labels = [], []
    for i in range(4000):
        length, scatter = lengths["ab"[i % 2]]
        lang, middle = [("en", 2.0), ("fr", 3.0), ("de", 2.0)][0 if i < 2400 else 1 if i < 3960 else 2]
        rows.append((i, lang, length, length * (middle + scatter * ((i // 2) % 21 - 10) / 10)))
        labels.append((i, 1, 0))
    rows += [(-1, "xx", 60, 1.0), (-2, "fr", 1, 1.0)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, length long, loss double")
    bound = {(r["lang"], r["class"]): r["bound"] for r in kn.limits(scored, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    for lang, middle in (("en", 2.0), ("fr", 3.0)):
        assert middle + 0.8 < bound[lang, 5] < middle + 1.3 and middle + 0.1 < bound[lang, 10] < middle + 0.2
    assert bound["fr", 0] > 3.8  # a class without documents has the limit of the shortest that has some
    assert bound["xx", 5] > bound["en", 10] and bound["de", 10] < bound["de", 5]


def test_short_bad_texts_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").drop("lang", "source")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("doc_id % 4 = 1 OR quality = 0")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi").selectExpr("*", "'en' AS lang")
    judged = kn.classify(docs, labels).join(labels, "doc_id").where("length <= 100 AND quality = 0").collect()
    assert len(judged) == 12 and sum(not r["kept"] for r in judged) > 3


def test_model_is_of_every_trusted_document(spark):
    labels = spark.range(30_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    trusted = spark.range(31_000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    fitted = kn.training_texts(trusted, labels)
    held = kn._trusted(labels).where("held").count()
    assert kn.trusted_ids(labels).count() == fitted.count() == 30_000 - held > 20_000
    assert fitted.where("doc_id >= 30000 OR text <> concat('t', doc_id)").count() == 0
