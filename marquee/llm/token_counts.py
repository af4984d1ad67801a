"""Token counts without encoding every word (operator 7).

The model turns spaces into the mark U+2581 and puts one before the text. If no vocabulary string
has a mark after another character, no merge crosses from a character to a mark, so a text can be
cut before each run of marks and the parts encoded alone: ``cuttable`` proves this for a model. A
part whose string is proven to encode alone as one token (``single_tokens``) counts 1 by lookup;
only the other distinct parts are encoded, once per task while they stay in its cache.

Defined cases: null and empty texts have 0 bytes and 0 tokens. Strings of special tokens are
ordinary text, which is the library's default. Texts of any length are counted whole; one without
spaces is a single part. Repeated rows each count. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.words import Hashes, text_bytes, text_slices

MARK = "▁"
#: Parts that a task remembers; the memory is emptied when it is full.
CACHE = 400_000
#: Longer parts are encoded each time and not remembered.
LONGEST = 64

_models: dict[str, object] = {}


def _model(path: str):
    if path not in _models:
        import sentencepiece

        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def cuttable(path: str) -> bool:
    """Whether no vocabulary string has the mark after another character, and the mark is one token."""
    model = _model(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return MARK in pieces and not any(MARK in p.lstrip(MARK) for p in pieces)


def single_tokens(path: str) -> list[str]:
    """Strings without spaces that the model encodes alone as one token, by trying each vocabulary string."""
    model = _model(path)
    words = [p[1:] for p in map(model.id_to_piece, range(model.get_piece_size())) if p.startswith(MARK) and len(p) > 1 and MARK not in p[1:]]
    return [w for w, ids in zip(words, model.encode(words, num_threads=1)) if len(ids) == 1]


def _hashes_of(strings: list[str]) -> np.ndarray:
    data, offsets = text_bytes(pa.array(strings, pa.string()))
    return np.sort(Hashes(data).of(offsets[:-1], offsets[1:]))


def _parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the parts: the first space of each run inside a text is a cut and is left out."""
    space = data == 32
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    cut[edges] = False
    cut = np.flatnonzero(cut)
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    start = np.sort(np.concatenate([offsets[filled], cut + 1]))
    end = np.sort(np.concatenate([cut, offsets[filled + 1]]))
    row = np.searchsorted(offsets[1:], np.minimum(start, np.maximum(end - 1, 0)), side="right")
    return start, end, row


class _Counter:
    def __init__(self, path: str, single: np.ndarray):
        self.model, self.single, self.seen = _model(path), single, {}

    def count(self, column: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(column)
        start, end, row = _parts(data, offsets)
        if not len(start):
            return np.zeros(len(column), np.int64)
        keys, first, back = np.unique(Hashes(data).of(start, end), return_index=True, return_inverse=True)
        counts = np.ones(len(keys), np.int64)
        size = (end - start)[first]
        rest = np.flatnonzero((size > 0) & ~np.isin(keys, self.single))  # an empty part is a lone mark: one token
        seen = self.seen
        known = [seen.get(k, -1) for k in keys[rest].tolist()]
        counts[rest] = known
        new = rest[np.array(known, np.int64) < 0]
        texts = [data[start[i] : end[i]].tobytes().decode() for i in first[new].tolist()]
        counts[new] = [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        if len(seen) + len(new) > CACHE:
            seen.clear()
        short = new[size[new] <= LONGEST]
        seen.update(zip(keys[short].tolist(), counts[short].tolist()))
        return np.bincount(row, counts[back], len(column)).astype(np.int64)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every document."""
    if not cuttable(path):
        raise ValueError(f"{path}: its merges can cross spaces, so texts can't be cut there")
    single = docs.sparkSession.sparkContext.broadcast(_hashes_of(single_tokens(path)))  # bounded by the vocabulary

    source = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.replace("text", F.lit(MARK), F.lit(" ")).alias("text"),  # the model reads both alike
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(path, single.value)
        for batch in text_slices(batches, "text"):
            columns = [batch["doc_id"], batch["n_bytes"], pa.array(counter.count(batch["text"]))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    schema = source.select("doc_id", "n_bytes").schema.add("n_tokens", "long")
    return source.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
