"""Vectorised views of text columns inside Arrow tasks: bytes, words, lines and their hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D. These are ASCII, so byte
positions in UTF-8 give the same words as code points. Hashes are 64 bits wide and depend on
the bytes alone, so they agree between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Rows are handled in slices of about so many bytes of text; one longer text is a slice of its own.
SLICE_BYTES = (1 << 20) - 1

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that the text of each stays near ``limit`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null: none), and the n+1 row offsets into them."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - offsets[0]


#: Masks for the last 0 to 8 bytes of a range.
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


class Hashes:
    """Hashes of byte ranges of ``data``: each eight bytes are scrambled with their place in the range, then added up."""

    def __init__(self, data: np.ndarray):
        self._padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self._eights = np.ndarray(len(data) + 1, "<u8", self._padded, strides=(1,))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        chunks = (size + 7) >> 3
        upto = np.concatenate([[0], np.cumsum(chunks)])
        place = np.arange(upto[-1]) - np.repeat(upto[:-1], chunks)
        value = self._eights[np.repeat(start, chunks) + 8 * place] & _MASK[np.minimum(np.repeat(size, chunks) - 8 * place, 8)]
        salt = mix(np.arange(1, chunks.max(initial=0) + 1, dtype=np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(value ^ salt[place]))])
        return mix(sums[upto[1:]] - sums[upto[:-1]] + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """Words of a slice: ``start`` and ``end`` byte positions, and ``row`` of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = ~SPACE[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        first = edges[edges < len(data)]
        opens[first] = inside[first]
        last = edges[edges > 0] - 1
        closes[last] = inside[last]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.row = np.searchsorted(offsets[1:], self.start, side="right")
        self.rows = len(offsets) - 1

    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)


def windows(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each k consecutive words of one row, and the index of the first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    out = np.zeros(len(at), np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[at + i]
    return mix(out), at


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each row's words, lower-cased in A-Z: hashes, sorted within rows, and the n+1 offsets.

    A text with fewer than n words is one shorter n-gram."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    words = Words(data, offsets)
    each, counts = Hashes(data).of(words.start, words.end), words.per_row()
    grams, rows = [], []
    for k in range(1, n + 1):
        found, at = windows(each, words.row, k)
        row = words.row[at]
        if k < n:
            short = counts[row] == k
            found, row = found[short], row[short]
        grams.append(found + np.uint64(n - k))
        rows.append(row)
    gram, row = np.concatenate(grams), np.concatenate(rows)
    order = np.lexsort((gram, row))
    gram, row = gram[order], row[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
    gram, row = gram[new], row[new]
    return gram, np.searchsorted(row, np.arange(words.rows + 1))


def set_hashes(gram: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each row's set; equal sets have equal ones."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(gram))])
    sizes = np.diff(bounds)
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + sizes.astype(np.uint64)).view(np.int64)


def shared(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many values the i-th set of x and the i-th of y have in common; sets as (values, offsets)."""
    sizes = np.diff(x[1]), np.diff(y[1])
    pair = np.concatenate([np.repeat(np.arange(len(s)), s) for s in sizes])
    key = mix(np.concatenate([x[0], y[0]]) + pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    key = key[order]
    return np.bincount(pair[order[1:][key[1:] == key[:-1]]], minlength=len(sizes[0]))
