"""Concatenate and cut: documents packed into sequences of a fixed length (operator 2).

Pass one encodes every document once and writes its ids with their offset inside the task's
partition. Prefix sums over the partitions' token totals turn these into global offsets. Pass two
cuts the ids at the multiples of the sequence length, so every sequence but the last is full and a
document that crosses a boundary leaves one piece on either side.

The order of documents is that of the written partitions, which stays fixed once they are written.
A lost executor costs only its unfinished tasks: ids are read from the shared folder.

A part of a text is encoded once per worker while it stays in its memory. The tokenizer drops white
space, and parts letters from punctuation, so texts are cut there; words with an apostrophe or "<"
(contractions, special strings) and bytes other than ASCII are left together. Defined cases: a null or empty text is the end id alone. One text may fill many
sequences. Repeated rows are packed as often as they occur. Other columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import shared_folder
from marquee.llm.words import LOWER, SLICE_BYTES, Hashes, Words, text_bytes, text_slices

END_ID = 1
#: Parts that a worker remembers; the memory is emptied when it is full.
REMEMBERED = 2_000_000

_LETTER, _MARK, _KEEP = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = _LETTER
_KIND[[i for i in range(33, 127) if not _KIND[i]]] = _MARK
_KIND[[39, 60]] = _KEEP  # apostrophe, <


def _parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z made small, and start, end and row of the parts whose ids follow one another."""
    words = Words(data, offsets)
    kind = _KIND[data]
    held = np.concatenate([[0], np.cumsum(kind == _KEEP)])
    free = held[words.end] == held[words.start]
    at = np.flatnonzero((kind[1:] ^ kind[:-1]) == (_LETTER ^ _MARK)) + 1  # a letter or digit beside a mark
    word = np.searchsorted(words.start, at, side="right") - 1
    at = at[free[word] & (at > words.start[word])]
    start, end = np.sort(np.concatenate([words.start, at])), np.sort(np.concatenate([words.end, at]))
    small = LOWER[data]
    small[:-1] = np.where(data[1:] >= 128, data[:-1], small[:-1])  # a letter can join with a mark behind it
    return small, start, end, np.searchsorted(offsets[1:], start, side="right")


class _Encoder:
    """Ids of whole texts from the ids of their parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.last = np.zeros(size, bool)  # tokens that end a word
        for token, i in self.tokenizer.get_vocab().items():
            self.last[i] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted, with the entry of each
        self.entry = self.start = self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.kind)

    def _new(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and how many each has."""
        sizes = np.zeros(len(texts), np.int64)
        ids: list = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if t.isalpha()]  # one word each, so each ends with the end of a word
        for at in range(0, len(plain), 256):
            some = plain[at : at + 256]
            found = np.array(self.tokenizer.encode(" ".join([texts[i] for i in some]), add_special_tokens=False).ids, self.kind)
            ends = np.flatnonzero(self.last[found]) + 1
            if len(ends) != len(some):
                continue
            for i, part in zip(some, np.split(found, ends[:-1])):
                ids[i] = part
        rest = [i for i, x in enumerate(ids) if x is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            ids[i] = np.array(e.ids, self.kind)
        sizes[:] = [len(x) for x in ids]
        return np.concatenate([np.zeros(0, self.kind), *ids]), sizes

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        data, offsets = text_bytes(column)
        data, start, end, row = _parts(data, offsets)
        keys, first, back = np.unique(Hashes(data).of(start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        known[at < len(self.keys)] = self.keys[at[at < len(self.keys)]] == keys[at < len(self.keys)]
        new = np.flatnonzero(~known)
        entry = np.zeros(len(keys), np.int64)
        entry[known] = self.entry[at[known]]
        starts, sizes, flat = self.start, self.size, self.ids
        if len(new):
            more, size = self._new([data[start[i] : end[i]].tobytes().decode() for i in first[new].tolist()])
            entry[new] = len(sizes) + np.arange(len(new))
            starts = np.concatenate([starts, len(flat) + np.cumsum(size) - size])
            sizes, flat = np.concatenate([sizes, size]), np.concatenate([flat, more])
            if len(data) <= 2 * SLICE_BYTES:  # else parts can be of any length
                self.keys, self.entry = np.insert(self.keys, at[new], keys[new]), np.insert(self.entry, at[new], entry[new])
                self.start, self.size, self.ids = starts, sizes, flat
        size, at = sizes[entry][back], starts[entry][back]
        ends = np.cumsum(size)
        every = flat[np.repeat(at - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[np.searchsorted(row, np.arange(len(offsets)))]
        return [every[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


_encoders: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    """The worker's encoder, which remembers parts from one task to the next."""
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """Written once: doc_id, part, start (offset in the part), n_tokens and ids (little-endian, 16 bits where they fit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = _encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([END_ID], encoder.kind)
        for batch in text_slices(batches, "text"):
            ids = [np.concatenate([x, end]) for x in encoder.encode(batch["text"])]
            sizes = np.array([len(x) for x in ids], np.int64)
            starts = start + np.cumsum(sizes) - sizes
            start += int(sizes.sum())
            columns = [batch["doc_id"], pa.array(np.full(len(ids), part)), pa.array(starts), pa.array(sizes), pa.array([x.tobytes() for x in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "start", "n_tokens", "ids"])

    source = docs.select("doc_id", "text")
    schema = source.select("doc_id").schema.add("part", "long").add("start", "long").add("n_tokens", "long").add("ids", "binary")
    folder = shared_folder(docs.sparkSession, "ids")
    source.mapInArrow(run, schema).write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(schema).parquet(folder)


def pack(docs: DataFrame, path: str, length: int = 2048) -> DataFrame:
    """Pieces: doc_id, start, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    rows = encoded(docs, path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # one row per written partition, however many documents there are
    bases = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in _slices(batch):
                yield _cut(cut, length)

    placed = rows.join(F.broadcast(bases), "part").select("doc_id", "n_tokens", "ids", (F.col("base") + F.col("start")).alias("at"))
    schema = placed.select("doc_id").schema
    for name, kind in (("start", "long"), ("ids", "binary"), ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long")):
        schema = schema.add(name, kind)
    return placed.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, tokens: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    start, held = 0, 0
    for i, n in enumerate(batch["n_tokens"].to_pylist()):
        if held and held + n > tokens:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def _cut(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    row, start, ids, tokens, sequence, offset = [], [], [], [], [], []
    for i, (n, at, packed) in enumerate(zip(batch["n_tokens"].to_pylist(), batch["at"].to_pylist(), batch["ids"].to_pylist())):
        wide = np.frombuffer(packed, np.uint16 if len(packed) == 2 * n else np.uint32).astype("<u4")
        done = 0
        while done < n:
            window, within = divmod(at + done, length)
            size = min(n - done, length - within)
            row.append(i)
            start.append(done)
            ids.append(wide[done : done + size].tobytes())
            tokens.append(n)
            sequence.append(window)
            offset.append(within)
            done += size
    columns = [batch["doc_id"].take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(ids, pa.binary())]
    columns += [pa.array(x, pa.int64()) for x in (tokens, sequence, offset)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])


def with_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with length and ids_crc32 in place of the ids."""
    return pieces.select(
        "doc_id",
        "start",
        F.expr("octet_length(ids) div 4").cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
