import pytest

HARD_TEXTS = [
    None, "", " ", "\n\n", "a", "one two", "Same text here.", "Same text here.", "  lead and  gaps   ", "tab\tand\r\nlines\n\nlines\n",
    "naïve Ümläut ñandú — “quotes” 你好 世界 🙂 <s> <|endoftext|> ▁mark ▁▁two 12345 don't it's", " no break wide", "x" * 3000,
    "word " * 4000, "a b c d e f g h i j k l\n" * 40, "the quick brown fox jumps over the lazy dog " * 20, "é combining ́mark \x00 nul",
]

#: Two words that a polynomial hash modulo a power of two can't tell apart, whatever its base.
TWINS = ["".join("ab"[i.bit_count() % 2 ^ flip] for i in range(1024)) for flip in (0, 1)]
HARD_TEXTS += [*TWINS, "\n".join(TWINS) + "\none line more, so that there are ten words in all"]


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and columns that clash with results."""
    rows = [(i, t, ["en", None, "de"][i % 3], ["s1", "s2", None][i % 3], 7, "x", True) for i, t in enumerate(HARD_TEXTS)]
    rows += [rows[6], rows[6], (None, "no id at all", None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_tokens int, shard string, kept boolean"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    return docs.selectExpr("*", "1 AS id", "'h' AS hash", "2 AS class", "3 AS bin", "'d' AS document", "4 AS epoch", "null AS weight", "5 AS part", "6 AS length")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def some_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
