import math
from collections import Counter, defaultdict

from marquee.llm.mixing import Plan, _counted, mix, mixed_documents


def shares(rows):
    tokens = Counter()
    for r in rows:
        tokens[r["source"]] += r["n_tokens"]
    return tokens


def test_weights_and_budgets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = Plan(_counted(docs), 2.0, 0.999, 20_000, "s")
    natural = shares(_counted(docs).collect())
    total = sum(natural.values())
    p = {s: n / total for s, n in natural.items()}

    def flattened(a):
        z = sum(x**a for x in p.values())
        return {s: x**a / z for s, x in p.items()}

    def fits(a):
        w = flattened(a)
        repeats = [w[s] / p[s] for s in p]
        return max(repeats) / min(repeats) <= 2.0 and -sum(x * math.log(x) for x in w.values()) <= 0.999 * math.log(len(p))

    assert fits(plan.exponent + 1e-9) and not fits(plan.exponent - 1e-4)
    rows = mix(docs, 2.0, 0.999, 20_000, "s").collect()
    passes = defaultdict(Counter)
    for r in rows:
        passes[r["doc_id"]][r["epoch"]] += 1
    assert set(passes) == {r["doc_id"] for r in docs.collect()}  # nothing is dropped
    got, weights = shares(rows), flattened(plan.exponent)
    longest = max(r["n_tokens"] for r in rows)
    budget = sum(r["budget"] for r in plan.limits.collect())
    for s, w in weights.items():
        assert 0 <= got[s] - w * budget <= longest + len(p)
    by_block = defaultdict(list)
    for r in rows:
        by_block[r["block"]].append(r["slot"])
    assert sorted(by_block) == list(range(plan.blocks)) and all(sorted(s) == list(range(len(s))) for s in by_block.values())


def test_order_and_columns(hard_docs, no_docs):
    mixed = mixed_documents(hard_docs, block_tokens=1000)
    assert mixed.columns == hard_docs.columns
    assert set(mixed.collect()) == set(hard_docs.collect())
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(r["doc_id"] for r in mix(hard_docs, block_tokens=1000).collect())
    assert mix(no_docs).collect() == [] and mixed_documents(no_docs).collect() == []


def test_uniform_sources_pass_once(spark):
    docs = spark.range(40).selectExpr("id as doc_id", "'a b c' as text", "concat('s', id % 4) as source")
    assert sorted(r["doc_id"] for r in mix(docs).collect()) == list(range(40))


def test_documents_without_tokens_are_dealt_over_the_blocks(spark):
    rows = [(i, " ", "blank") for i in range(1000)] + [(1000 + i, "word " * 100, "full") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    blocks = Counter(r["block"] for r in mix(docs, block_tokens=1000).where("source = 'blank'").collect())
    assert blocks.total() == 1000 and len(blocks) >= 36 and max(blocks.values()) < 100
