import math
import re
from collections import Counter

from marquee.llm.quality_rules import EXACT, FENCE, MEASURES, RATIO, SPREAD, SUPPORT, filter_documents, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def binned(x):
    return x if x <= EXACT else math.floor(EXACT * RATIO ** math.floor(math.log(x / EXACT) / math.log(RATIO)))


def verdicts(rows):
    """kept by the definition, for (lang, source, text)."""
    measured = []
    for lang, source, text in rows:
        n, chars, symbols, lines, repeats = slow(text)
        base = n < 10 or 100 * repeats > 20 * n
        bins = None if not n else {"symbols": 1000 * symbols // n, "dup_lines": 1000 * lines // n, "word_length": 100 * chars // n}
        measured.append((lang or "", source or "", base, bins))
    out = []
    for lang, source, base, bins in measured:
        if base:
            out.append(False)
            continue
        own = [b for x, y, f, b in measured if not f and (x, y) == (lang, source)]
        same = [b for x, _, f, b in measured if not f and x == lang]
        group = own if len(own) >= SUPPORT else same if len(same) >= SUPPORT else [b for _, _, f, b in measured if not f]
        good = True
        for m in MEASURES:
            values = sorted(binned(b[m]) for b in group)
            q1, q3 = (values[-(-len(values) * k // 4) - 1] for k in (1, 3))
            reach = max(FENCE * (q3 - q1), SPREAD[m], math.ceil(q3 * (RATIO - 1)) + 2 if q3 > EXACT else 0)
            good &= bins[m] <= q3 + reach and (m != "word_length" or bins[m] >= q1 - reach)
        out.append(good)
    return out


def test_against_the_definition(spark, hard_docs, monkeypatch):
    monkeypatch.setattr("marquee.llm.quality_rules.SUPPORT", 20)
    monkeypatch.setitem(globals(), "SUPPORT", 20)
    docs = hard_docs.select("doc_id", "text", "lang", "source").union(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id + 1000", "text", "lang", "source"))
    rows = docs.collect()
    expected = Counter((r["doc_id"], *slow(r["text"]), k) for r, k in zip(rows, verdicts([(r["lang"], r["source"], r["text"]) for r in rows])))
    got = quality_rules(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["kept"]) for r in got) == expected
    assert all(r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) for r in got)


def test_filter_keeps_rows_whole(hard_docs, no_docs):
    kept = filter_documents(hard_docs)
    assert kept.columns == hard_docs.columns
    every, left = Counter(hard_docs.collect()), Counter(kept.collect())
    assert not left - every and left
    assert sum(left.values()) == quality_rules(hard_docs).where("kept").count()
    assert filter_documents(no_docs).collect() == [] and quality_rules(no_docs).collect() == []


def test_values_have_no_cap(spark):
    """Words of more than 100 code points, and more than 10 symbols a word: a group of such texts keeps them, and loses what lies outside."""
    long = [(i, " ".join("字" * (90 + i % 80 + k) for k in range(10)), "zh", "s") for i in range(300)]
    some = [(1000, " ".join("字" * (90 + k) for k in range(10)), "zh", "s"), (1001, " ".join("字" * (2000 + k) for k in range(10)), "zh", "s")]
    marks = [(i, " ".join("a" * k + "#" * 500 for k in range(10)), "x", "s") for i in range(2000, 2300)]
    marks += [(3000, " ".join("a" * k + "#" * 5000 for k in range(10)), "x", "s")]
    rows = long + some + marks
    kept = {r["doc_id"]: r["kept"] for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [kept[r[0]] for r in rows] == verdicts([(r[2], r[3], r[1]) for r in rows])
    assert all(kept[i] for i in range(300)) and kept[1000] and not kept[1001]
    assert all(kept[i] for i in range(2000, 2300)) and not kept[3000]


def test_a_text_passes_to_python_once(spark, monkeypatch):
    """Beside their documents the texts are read inside them: the task gets no second column of texts."""
    from pyspark.sql import functions as F

    from marquee.llm import quality_rules as Q

    texts = [None, "", "one two\none two\n# three", "x " * 300, "é ü " * 200]
    docs = spark.createDataFrame([(i, t, "en", None, i * 10) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, other long")
    monkeypatch.setattr(Q, "SLICE", 100)
    own = {r.doc_id: tuple(r)[1:] for r in Q.measured(docs.select("doc_id", "text"), ["doc_id"]).collect()}
    found = Q.measured(docs.select(F.struct("*").alias("document")), ["document"], "document")
    assert {r.document.doc_id: tuple(r)[1:] for r in found.collect()} == own and own[2] == slow(texts[2])
    assert {r.document.doc_id: r.document.text for r in found.collect()} == dict(enumerate(texts))
    seen, plain = [], Q.measured
    monkeypatch.setattr(Q, "measured", lambda d, *a: seen.append(d.columns) or plain(d, *a))
    Q.filter_documents(docs)
    assert [c for c in seen if "document" in c] == [["document", "lang", "source"]]
