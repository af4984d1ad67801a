import pytest
import sentencepiece

from marquee.llm.common import tokenizer_file
from marquee.llm.token_counts import count_tokens, single_tokens

FILE = tokenizer_file("piece_bpe_32k.model")


@pytest.mark.parametrize("name", ["hard_docs", "some_docs"])
def test_counts_are_the_library_s(name, request):
    docs = request.getfixturevalue(name)
    model = sentencepiece.SentencePieceProcessor(model_file=FILE)
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["n_bytes"] if "n_bytes" in r else len((r["text"] or "").encode()))
    expected = sorted((key(r.asDict()), len(model.encode(r["text"] or ""))) for r in docs.collect())
    got = count_tokens(docs, FILE, 100).collect()
    assert sorted((key(r.asDict()), r["n_tokens"]) for r in got) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)


def test_spaces_and_marks(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=FILE)
    texts = ["a", " a", "a ", "  a  b   c ", " ", "   ", "a▁b", "▁", "a ▁ b", "a　b", "x  ", "1 2  3", "\n", " \n ", "a\n b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs, FILE).collect()}
    assert got == {i: len(model.encode(t)) for i, t in enumerate(texts)}


def test_single_tokens_are_proven():
    model = sentencepiece.SentencePieceProcessor(model_file=FILE)
    words = single_tokens(FILE)
    assert len(words) > 10_000 and all(len(model.encode(w)) == 1 for w in words[::50])


def test_empty(no_docs):
    assert count_tokens(no_docs, FILE).collect() == []
