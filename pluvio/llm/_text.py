"""Word and shingle hashing over Arrow string columns, vectorised with numpy.

A word is a maximal run of ASCII letters and digits and of non-ASCII characters, lower-cased over A-Z only. In UTF-8
that is a property of single bytes, so a whole batch of texts is cut with a byte table and hashed with prefix sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Bytes and rows of text handled at once; a longer single text is a slice of its own.
SLICE_BYTES, SLICE_ROWS = 1 << 18, 256

_BYTE = np.zeros(256, np.uint8)
_BYTE[48:58] = np.arange(48, 58)
_BYTE[97:123] = np.arange(97, 123)
_BYTE[65:91] = np.arange(97, 123)
_BYTE[128:] = np.arange(128, 256)

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BYTE_VALUE[0] = 0


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = base, _inverse(base)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inv)):
                a = np.full(size, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


_CHARS = _Powers(0xD6E8FEB86659FD93)
_WORDS = (_Powers(0xA0761D6478BD642F), _Powers(0xE7037ED1A0B428DB))


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """Position-weighted sums of values[start:end], alike wherever the span stands."""
    up, down = powers.to(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


@dataclass
class Words:
    """Words of some texts: byte spans, hashes, and for text i the words offset[i]:offset[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    offset: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offset)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offset) - 1), self.counts)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and the offsets of each; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def words(data: np.ndarray, rows: np.ndarray) -> Words:
    b = _BYTE[data]
    inside = b != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = rows[:-1][rows[:-1] < rows[1:]]
    first[cut] = inside[cut]
    cut = rows[1:][rows[:-1] < rows[1:]] - 1
    last[cut] = inside[cut]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    h = mix(span_sums(_BYTE_VALUE[b], start, end, _CHARS) + (end - start).astype(np.uint64) * _ODD)
    return Words(start, end, h, np.searchsorted(start, rows))


def prefix_hashes(data: np.ndarray, w: Words, chars: int) -> np.ndarray:
    """For each word the hash that its first `chars` characters have as a word."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(lead):
        return np.zeros(0, np.uint64)
    after = np.searchsorted(lead, w.start) + chars
    end = np.minimum(w.end, np.where(after < len(lead), lead[np.minimum(after, len(lead) - 1)], len(data)))
    return mix(span_sums(_BYTE_VALUE[_BYTE[data]], w.start, end, _CHARS) + (end - w.start).astype(np.uint64) * _ODD)


def text_keys(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's sequence of words."""
    n = w.counts.astype(np.uint64)
    return tuple(mix(span_sums(w.hash, w.offset[:-1], w.offset[1:], p) + n * _ODD) for p in _WORDS)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of `size` words; a text with fewer words, but some, is one shingle."""
    n = len(w.hash)
    at = np.arange(n)
    row = w.row
    left = w.offset[1:][row] - at if n else at
    keep = (left >= size) | ((w.counts[row] < size) & (at == w.offset[:-1][row])) if n else np.empty(0, bool)
    at, row = at[keep], row[keep]
    end = np.minimum(at + size, w.offset[1:][row]) if len(at) else at
    return row, mix(span_sums(w.hash, at, end, _WORDS[0]) + (end - at).astype(np.uint64))


def slices(batches: Iterator[pa.RecordBatch], column: int | str) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a slice stay below SLICE_BYTES and SLICE_ROWS, or are one text."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = size[at - 1] if at else 0
            to = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(size, done + SLICE_BYTES, "right"))))
            yield batch.slice(at, to - at)
            at = to


def map_arrow(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """df.mapInArrow. Spark bounds its batches by rows and bytes; slices() cuts what a step works on at once."""
    return df.mapInArrow(run, schema)


def list_offsets(counts: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.array(offsets)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(list_offsets(counts), pa.array(values, kind))
