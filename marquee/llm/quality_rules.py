"""Quality rules whose thresholds follow each language and source (operator 4).

Every document gets word, symbol and repetition measures. Repeated words have the base rule alone: a fence
below it rejects clean documents and no more bad ones (README). The measures of the documents that
pass the base rules are counted into bins per (lang, source): a quantile sketch that merges by adding
counts. Up to ``EXACT`` a bin is one wide, above that ``RATIO`` times the one below, so their number is
bounded by the logarithm of the values. Quartiles of the merged sketches give fences
(quartile -/+ ``FENCE`` x interquartile range, at least ``SPREAD`` bins wide, or the bin of the quartile), and the small table of
fences is joined back to the measures, whose own values are compared.

Defined cases: a null or blank text has no words and fails the base rules. A null lang or source
is a group of its own, as '' (joined with the empty string). Groups with fewer than ``SUPPORT``
documents use the fences of their language, and languages with fewer use those of all documents.
Ties and repeated rows each count. Columns of the input other than doc_id, text, lang and source
are not read, or are carried untouched inside one struct by ``filter_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import written
from marquee.llm.words import Hashes, Words, mix, text_bytes, text_slices, windows

#: Base rules, fixed by the contract.
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
#: Fences: interquartile ranges beyond the quartile, and documents that a group needs for its own.
FENCE, SUPPORT = 3, 200
#: Least distance of the fence from the quartile, in bins (thousandths a word; hundredths of a code point).
SPREAD = {"symbols": 100, "dup_lines": 100, "word_length": 300}
#: Values up to this one have bins of their own; those above are counted in bins that grow by a ratio.
EXACT, RATIO = 10_000, 1.02
MEASURES = list(SPREAD)
#: Texts are measured about so many bytes at a time: the positions and hashes of a slice take about a hundred times that.
SLICE = (1 << 18) - 1

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def _repeats(key: np.ndarray) -> np.ndarray:
    """Which entries have an equal one elsewhere."""
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    found = np.zeros(len(key), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def _measure(column: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = text_bytes(column)
    rows = len(offsets) - 1
    words, hashes = Words(data, offsets), Hashes(data)
    out = {"n_words": words.per_row()}

    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    out["word_chars"] = np.bincount(words.row, points[words.end] - points[words.start], rows)
    symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[data])])
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]

    at = np.flatnonzero(data == 10)
    start = np.concatenate([offsets[:-1], at + 1])
    end = np.concatenate([at, offsets[1:]])
    row = np.concatenate([np.arange(rows), np.searchsorted(offsets[1:], at, side="right")])
    start.sort()
    end.sort()
    row.sort()
    full = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, row = start[full], end[full], row[full]
    key = mix(hashes.of(start, end) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(row, minlength=rows) - np.bincount(row[first], minlength=rows)

    key, at = windows(hashes.of(words.start, words.end), words.row, REPEAT_WINDOW)
    at = at[_repeats(mix(key + words.row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))]
    edge = np.zeros(len(words.row) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = np.bincount(words.row, np.cumsum(edge[:-1]) > 0, rows)
    return out


def measured(docs: DataFrame, keep: list[str], inside: str | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` and the five counts of its ``text``, or of the text in its struct ``inside``, which
    is one of ``keep``, so that a text passes to Python once."""
    source = docs.select(*keep, "text") if inside is None and "text" not in keep else docs.select(*keep)
    kept = source.select(*keep)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch if inside is None else batch.append_column("text", pc.struct_field(batch.column(inside), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(texts(batches), "text", SLICE):
            counts = _measure(batch.column("text"))
            columns = [batch.column(c) for c in keep]
            columns += [pa.array(counts[c].astype(np.int64)) for c in _COUNTS]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *_COUNTS])

    schema = kept.schema
    for c in _COUNTS:
        schema = schema.add(c, "long")
    return source.mapInArrow(run, schema)


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _values() -> dict:
    return {
        "symbols": F.expr("1000 * n_symbols div n_words"),
        "dup_lines": F.expr("1000 * n_dup_lines div n_words"),
        "word_length": F.expr("100 * word_chars div n_words"),
    }


def _bin(value: Column) -> Column:
    """The least value of a value's bin."""
    steps = F.floor(F.log(value / EXACT) / math.log(RATIO))
    return F.when(value <= EXACT, value).otherwise(F.floor(EXACT * F.pow(F.lit(RATIO), steps))).cast("long")


def sketches(measures: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): one mergeable sketch per language, source and measure."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), _bin(v).alias("bin")) for m, v in _values().items()])
    return (
        measures.where(~_base_failed())
        .select("lang", "source", F.explode(pairs).alias("p"))
        .groupBy("lang", "source", "p.measure", "p.bin")
        .agg(F.count("*").alias("n"))
    )


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, <measure>_low, <measure>_high) for each group of the sketch."""
    levels = [["lang", "source"], ["lang"], []]
    out = None
    for keys in levels:
        of = Window.partitionBy(*keys, "measure")
        merged = sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))
        ranked = merged.select(
            *keys,
            "measure",
            "bin",
            F.sum("n").over(of.orderBy("bin")).alias("below"),
            F.sum("n").over(of).alias("total"),
        )
        quartiles = ranked.groupBy(*keys, "measure").agg(
            F.max("total").alias("total"),
            F.min(F.when(4 * F.col("below") >= F.col("total"), F.col("bin"))).alias("q1"),
            F.min(F.when(4 * F.col("below") >= 3 * F.col("total"), F.col("bin"))).alias("q3"),
        )
        columns = [F.max("total").alias("total")]
        for m, spread in SPREAD.items():
            width = F.when(F.col("q3") > EXACT, F.ceil(F.col("q3") * (RATIO - 1)) + 2).otherwise(0)
            reach = F.greatest(FENCE * (F.col("q3") - F.col("q1")), F.lit(spread), width)
            this = F.col("measure") == m
            columns.append(F.max(F.when(this, F.col("q1") - reach)).alias(f"{m}_low"))
            columns.append(F.max(F.when(this, F.col("q3") + reach)).alias(f"{m}_high"))
        level = quartiles.groupBy(*keys).agg(*columns)
        limits = F.struct(*[f"{m}_{side}" for m in MEASURES for side in ("low", "high")])
        name = f"by_{len(keys)}"
        level = level.select(*keys, F.when((F.col("total") >= SUPPORT) | F.lit(not keys), limits).alias(name))
        if out is None:
            out = level
        elif keys:
            out = out.join(level, keys)
        else:
            out = out.join(F.broadcast(level))  # one row
    return out.select("lang", "source", F.coalesce("by_2", "by_1", "by_0").alias("limits")).select("lang", "source", "limits.*")


def _verdict():
    values = _values()
    inside = ~_base_failed()
    for m in ("symbols", "dup_lines"):
        inside &= values[m] <= F.col(f"{m}_high")
    return inside & values["word_length"].between(F.col("word_length_low"), F.col("word_length_high"))


def judge(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """``measures`` with base_failed and kept, by the fences of their groups."""
    joined = measures.join(limits, ["lang", "source"], "left")
    return joined.select(
        *measures.columns,
        _base_failed().alias("base_failed"),
        F.when(_base_failed(), F.lit(False)).otherwise(_verdict()).alias("kept"),
    )


def _group(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, "text", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))


def _measures(docs: DataFrame) -> DataFrame:
    return written(measured(_group(docs, "doc_id"), ["doc_id", "lang", "source"]), "measures")


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed and kept for every document."""
    measures = _measures(docs)
    limits = written(fences(sketches(measures)), "fences")
    return judge(measures, limits).select("doc_id", *_COUNTS, "base_failed", "kept")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns.

    The rows are measured once for the sketches and once more beside their own columns when the
    fences are known, so no text is shuffled or written and no key is needed to find a row again.
    """
    limits = written(fences(sketches(_measures(docs))), "fences")
    packed = _group(docs, F.struct("*").alias("document")).drop("text")
    return judge(measured(packed, ["document", "lang", "source"], "document"), limits).where("kept").select("document.*")
