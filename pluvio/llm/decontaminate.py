"""Benchmark passages in training documents, found with an FM-index of each training shard.

A shard's texts are written over the alphabet of the benchmark's words; every other word can be in no passage and ends a
run. The runs' Burrows-Wheeler transform is held in a wavelet matrix, whose ranks drive a backward search of all test
windows at once. Matches are located by stepping back to a sampled text position, and the matched words are merged into
removal spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._text import flat, list_offsets, lists, map_arrow, slices, words

WINDOW_WORDS = 13
#: A shard is indexed when it holds this many benchmark words, or as much text as SHARD_BYTES.
SHARD_SYMBOLS, SHARD_BYTES = 1 << 19, 32 << 20
#: Benchmark text broadcast at once; a larger benchmark is searched for in several passes.
BLOCK_BYTES = 4 << 20
SAMPLE_RATE = 8
SCHEMA = "id long, text_key long, n_words long, spans array<struct<first:int,last:int,start:int,end:int>>, items array<string>"
_SPAN = pa.struct([(name, pa.int32()) for name in ("first", "last", "start", "end")])


@dataclass
class Windows:
    """Test windows over symbols from 1: right-aligned rows of `pattern`, and the items of window i."""

    vocabulary: np.ndarray
    pattern: np.ndarray
    length: np.ndarray
    item: np.ndarray
    item_offset: np.ndarray
    names: np.ndarray


def windows(names: list[str], texts: list[str | None], size: int) -> Windows:
    w = words(*flat(pa.array(texts, pa.large_string())))
    vocabulary, symbol = np.unique(w.hash, return_inverse=True)
    symbol = symbol.reshape(-1).astype(np.int64) + 1
    rows, owners = [], []
    for i, (a, b) in enumerate(zip(w.offset[:-1], w.offset[1:], strict=True)):
        n = min(size, b - a)
        if n:
            part = np.lib.stride_tricks.sliding_window_view(symbol[a:b], n)
            rows.append(np.pad(part, ((0, 0), (size - n, 0))))
            owners.append(np.full(len(part), i))
    name, of = np.unique(np.array([str(x or "") for x in names], dtype=object).astype(str), return_inverse=True)
    if not rows:
        return Windows(vocabulary, np.zeros((0, size), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), name)
    pattern, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    pair = np.unique(np.stack([which.reshape(-1), of.reshape(-1)[np.concatenate(owners)]], axis=1), axis=0)
    return Windows(vocabulary, pattern, (pattern > 0).sum(axis=1), pair[:, 1], np.searchsorted(pair[:, 0], np.arange(len(pattern) + 1)), name)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted suffixes of a text over symbols from 1, in which each 0 ends a run and differs from every other 0."""
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text + ends.sum())
    n, step = len(text), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (max(int(rank.max()), n) + 2) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        step *= 2
        if rank.max() == n - 1 or step >= n:
            return order


class FMIndex:
    """Counts and places of patterns in runs of symbols, each run ended by a 0."""

    def __init__(self, text: np.ndarray, symbols: int, sample_rate: int = SAMPLE_RATE):
        order = suffix_array(text)
        bwt = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.bwt, self.levels = bwt, max(1, int(symbols).bit_length())
        self.ones, self.zeros = [], []
        level = bwt
        for bit in range(self.levels - 1, -1, -1):
            set_ = (level >> bit & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(set_)]).astype(np.int32))
            self.zeros.append(len(level) - int(set_.sum()))
            level = np.concatenate([level[~set_], level[set_]])
        self.base = np.zeros(symbols + 1, np.int64)
        self.base = self._down(np.arange(symbols + 1), np.zeros(symbols + 1, np.int64))
        at = np.arange(len(text))
        start = np.concatenate([[0], np.flatnonzero(text == 0) + 1])
        since = at - start[np.searchsorted(start, at, "right") - 1]
        self.sampled = (since % sample_rate == 0)[order]
        self.sample = order[self.sampled]
        self.sample_rank = np.cumsum(self.sampled) - 1

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            one = symbol >> (self.levels - 1 - level) & 1
            ones = self.ones[level][at]
            at = np.where(one == 1, self.zeros[level] + ones, at - ones)
        return at - self.base[symbol]

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Backward step: the row of symbol's rank before row `at`."""
        return self.before[symbol] + self._down(symbol, at)

    def search(self, pattern: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, row) ranges as (low, high) arrays, for right-aligned patterns."""
        low, high = np.zeros(len(pattern), np.int64), np.full(len(pattern), len(self.bwt), np.int64)
        for t in range(pattern.shape[1]):
            live = np.flatnonzero((t < length) & (low < high))
            if not len(live):
                break
            symbol = pattern[live, pattern.shape[1] - 1 - t]
            low[live], high[live] = self.step(symbol, low[live]), self.step(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in these rows."""
        place, todo, steps = np.empty(len(row), np.int64), np.arange(len(row)), 0
        while len(todo):
            found = self.sampled[row]
            place[todo[found]] = self.sample[self.sample_rank[row[found]]] + steps
            row, todo = row[~found], todo[~found]
            row = self.step(self.bwt[row], row)
            steps += 1
        return place


class _Shard:
    """Texts gathered for one index."""

    def __init__(self, test: Windows):
        self.test, self.least = test, int(test.length.min()) if len(test.length) else 0
        self.ids, self.keys, self.counts, self.symbols, self.rows, self.at, self.start, self.end = ([] for _ in range(8))
        self.n = self.size = self.bytes = 0

    def add(self, batch: pa.RecordBatch) -> None:
        data, offsets = flat(batch.column(2))
        w = words(data, offsets)
        self.ids.append(batch.column(0))
        self.keys.append(batch.column(1))
        self.counts.append(w.counts)
        known = self.test.vocabulary
        if len(known) and len(w.hash):
            at = np.minimum(np.searchsorted(known, w.hash), len(known) - 1)
            symbol = np.where(known[at] == w.hash, at + 1, 0)
            row = w.row
            new = np.ones(len(symbol), bool)
            new[1:] = (row[1:] != row[:-1]) | (symbol[1:] == 0) | (symbol[:-1] == 0)
            begin = np.flatnonzero(new)
            length = np.diff(np.append(begin, len(symbol)))
            keep = np.repeat((length >= self.least) & (symbol[begin] > 0), length)
            at = np.flatnonzero(keep)
            if len(at):
                last = np.append(np.diff(at) > 1, True) | np.append(row[at][1:] != row[at][:-1], True)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]).astype(np.int64)
                ends = np.flatnonzero(last) + 1
                put = lambda x, gap: np.insert(x, ends, gap)
                origin = points[offsets[row[at]]]
                self.symbols.append(put(symbol[at], 0))
                self.rows.append(put(row[at] + self.n, -1))
                self.at.append(put(at - w.offset[row[at]], -1))
                self.start.append(put(points[w.start[at]] - origin, -1))
                self.end.append(put(points[w.end[at]] - origin, -1))
                self.size += len(at) + len(ends)
        self.n += batch.num_rows
        self.bytes += len(data)

    @property
    def full(self) -> bool:
        return self.size >= SHARD_SYMBOLS or self.bytes >= SHARD_BYTES

    def result(self) -> pa.RecordBatch:
        spans, span_count = np.zeros((0, 4), np.int64), np.zeros(self.n, np.int64)
        pair = np.zeros((0, 2), np.int64)
        if self.size and self.least:
            text, row, at, start, end = (np.concatenate(x) for x in (self.symbols, self.rows, self.at, self.start, self.end))
            index = FMIndex(text, len(self.test.vocabulary))
            low, high = index.search(self.test.pattern, self.test.length)
            times = high - low
            which = np.repeat(np.arange(len(low)), times)
            place = index.locate(np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + low[which])
            change = np.bincount(place, minlength=len(text) + 1) - np.bincount(place + self.test.length[which], minlength=len(text) + 1)
            hit = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
            first, last = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(hit[:-1] & ~hit[1:]) - 1
            spans = np.stack([at[first], at[last] + 1, start[first], end[last]], axis=1)
            span_count = np.bincount(row[first], minlength=self.n)
            items = np.diff(self.test.item_offset)[which]
            item = self.test.item[np.arange(items.sum()) - np.repeat(np.cumsum(items) - items, items) + np.repeat(self.test.item_offset[which], items)]
            pair = np.unique(np.stack([np.repeat(row[place], items), item], axis=1), axis=0)
        span_values = pa.StructArray.from_arrays([pa.array(spans[:, i], pa.int32()) for i in range(4)], fields=list(_SPAN))
        names = lists(self.test.names[pair[:, 1]] if len(pair) else [], np.bincount(pair[:, 0], minlength=self.n), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(self.ids), pa.concat_arrays(self.keys), pa.array(np.concatenate(self.counts), pa.int64()), pa.ListArray.from_arrays(list_offsets(span_count), span_values), names],
            ["id", "text_key", "n_words", "spans", "items"],
        )


def _scan(texts: DataFrame, test: Windows) -> DataFrame:
    held = texts.sparkSession.sparkContext.broadcast(test)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(held.value)
        for batch in slices(batches, 2):
            shard.add(batch)
            if shard.full:
                yield shard.result()
                shard = _Shard(held.value)
        if shard.n:
            yield shard.result()

    return map_arrow(texts, run, SCHEMA)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, size: int, block_bytes: int) -> Iterator[Windows]:
    names, texts, used = [], [], 0
    for row in benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        names.append(row[0])
        texts.append(row[1])
        used += len(row[1] or "")
        if used >= block_bytes:
            yield windows(names, texts, size)
            names, texts, used = [], [], 0
    yield windows(names, texts, size)


def _merged(spans: Column) -> Column:
    """Spans sorted and joined where they overlap or touch."""
    longer = lambda last, s: F.struct(last["first"].alias("first"), F.greatest(last["last"], s["last"]).alias("last"), last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
    join = lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["last"] >= s["first"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer(F.element_at(acc, -1), s)))
    ).otherwise(F.concat(acc, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<first:int,last:int,start:int,end:int>>"), join)


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, n_words, n_hit, spans, items) of every document row.

    A window is `size` consecutive words of an item, or the whole item if it has fewer; items without words have none.
    spans: the merged runs of document words inside occurrences of windows, as word numbers first..last (exclusive) and
    code points start..end (exclusive). items: the items of those windows, by their ids as strings ("" for a null id),
    each once. A null text has no words and no hits. Repeated rows each have their row; other columns are not read.

    The benchmark comes to the driver in blocks of at most `block_bytes` of text (and one item), and each block is one
    pass over the documents with the block's windows broadcast, so that no benchmark is too large.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_key"), F.col(text_col).cast("string").alias("t"))
    parts = [_scan(texts, block) for block in _blocks(benchmark, item_col, item_text_col, size, block_bytes)]
    if len(parts) > 1:
        times = parts[0].groupBy("id", "text_key", "n_words").agg(F.count("*").alias("times"))
        hits = parts[0].where("size(spans) > 0")
        for part in parts[1:]:
            hits = hits.unionByName(part.where("size(spans) > 0"))
        hits = hits.groupBy("id", "text_key", "n_words").agg(F.flatten(F.collect_set("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
        on = [times[c].eqNullSafe(hits[c]) for c in ("id", "text_key", "n_words")]
        none = F.array()
        found = (
            times.join(hits, on, "left")
            .select(times.id, times.n_words, F.coalesce(hits["spans"], none.cast(hits.schema["spans"].dataType)).alias("spans"), F.coalesce("items", none.cast("array<string>")).alias("items"), F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("nth"))
            .withColumn("spans", _merged(F.col("spans")))
        )
    else:
        found = parts[0]
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select("id", "n_words", n_hit.alias("n_hit"), "spans", "items")


def contaminated() -> Column:
    """Some words are hit, and they are a twentieth of the document or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
