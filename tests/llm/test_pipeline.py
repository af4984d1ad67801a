import sys
from collections import Counter

import pytest

import corpus_pipeline
from marquee.llm.common import written
from marquee.llm.quality_rules import quality_rules

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "quality classifier", "n-gram Jaccard join", "mixing sources", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns, before = docs.columns, Counter(docs.collect())
    base = {r["doc_id"] for r in quality_rules(docs).where("base_failed").collect()}  # they go by contract
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = written(stage(spark, docs, SF), f"stage-{k}")
        assert docs.columns == columns
        after = Counter(docs.collect())
        assert set(after) <= set(before) and (k == 3 or not after - before), name
        if k < 2:
            gone = [labels[r["doc_id"]] for r in (before - after).elements() if r["doc_id"] in labels and r["doc_id"] not in base]
            assert not sum(gone), name  # no good document goes
        if k == 3:
            assert set(after) == set(before)
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert Counter(r["doc_id"] for r in pieces.where("start = 0").collect()) == Counter(r["doc_id"] for r in docs.collect())
    assert pieces.count() == corpus_pipeline.run(spark, SF).count()


@pytest.mark.parametrize("name", ["hard_docs", "no_docs"])
def test_hard_and_empty_inputs(spark, name, request):
    docs = request.getfixturevalue(name)
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = written(stage(spark, docs, SF), f"hard-{k}")
        if k < 4:
            assert out.columns == columns
            out.count()
            # each stage also gets the whole input, not only what is left of it
            assert stage(spark, request.getfixturevalue(name), SF).columns == columns
        docs = out
    docs.count()


def test_entry_without_the_subpackage(tmp_path):
    """The entry point imports, and the other queries are there, when both llm folders and the pipeline are gone."""
    import os
    import shutil
    import subprocess

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    copy = tmp_path / "copy"
    copy.mkdir()
    shutil.copy(f"{root}/__spark_entry__.py", copy)
    shutil.copytree(f"{root}/marquee", copy / "marquee", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 140 and 'pipeline' not in q and not any(n.startswith('op1') for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
