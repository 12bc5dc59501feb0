"""Byte-pair encoding and decoding with a pair occurrence index per block of texts.

The distinct pre-tokens of a block stand side by side in one symbol array. Each adjacent pair of symbols is mapped to all
its positions; ranks with positions are taken in ascending order, all positions of a rank are merged at once, and the
lists of the pairs that vanish and appear beside the merges are updated. As a merge makes a symbol that only later ranks
use (which is checked when a vocabulary is loaded), this gives the merges that a text alone would get.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ._text import map_arrow, slices

#: Pre-tokens: contractions, letters, digits and other marks with one leading space, and white space.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text encoded at once, and pre-tokens whose tokens a worker keeps between blocks.
BLOCK_CHARS, KEPT_TOKENS = 4 << 20, 250_000


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Byte sequences by id, pair ranks, and special strings, all as arrays and tables for numpy."""

    byte_ids: np.ndarray
    pairs: dict[int, int]
    left: np.ndarray
    right: np.ndarray
    merged: np.ndarray
    special: dict[str, int]
    data: np.ndarray
    offset: np.ndarray


def pair_code(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.int64) << 32 | right.astype(np.int64)


@lru_cache(maxsize=1)
def parse(text: str) -> Vocabulary:
    """A byte-level BPE vocabulary from the text of a tokenizers JSON file."""
    spec = json.loads(text)
    model, letters = spec["model"], _byte_letters()
    ids = model["vocab"]
    size = 1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])])
    spelled = [b""] * size
    for token, i in ids.items():
        spelled[i] = bytes(letters[c] for c in token)
    for t in spec["added_tokens"]:
        spelled[t["id"]] = t["content"].encode()
    byte_ids = np.zeros(256, np.int64)
    for letter, b in letters.items():
        byte_ids[b] = ids[letter]
    made = {int(i): -1 for i in byte_ids}
    pairs, merges = {}, []
    for rank, pair in enumerate(model["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        a, b, c = ids[left], ids[right], ids[left + right]
        if max(made[a], made[b]) >= rank:
            raise ValueError(f"merge {rank} uses a symbol of a later rank")
        made.setdefault(c, rank)
        pairs[a << 32 | b] = rank
        merges.append((a, b, c))
    return Vocabulary(byte_ids, pairs, *np.array(merges, np.int64).reshape(-1, 3).T, {t["content"]: t["id"] for t in spec["added_tokens"]}, np.frombuffer(b"".join(spelled), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in spelled])]))


def merge_all(symbols: np.ndarray, word_end: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The symbols after all merges, -1 where one was merged into its left neighbour. word_end marks a word's last symbol."""
    n = len(symbols)
    symbols = symbols.copy()
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    after[word_end] = n
    before[np.flatnonzero(word_end)[:-1] + 1] = -1
    ranks = vocabulary.pairs
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enlist(at: np.ndarray) -> None:
        """Add these left positions to the lists of their pairs."""
        at = at[after[at] < n]
        if not len(at):
            return
        code = pair_code(symbols[at], symbols[after[at]])
        order = np.argsort(code, kind="stable")
        at, code = at[order], code[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        for c, a, b in zip(code[first].tolist(), first.tolist(), [*first[1:].tolist(), len(code)], strict=True):
            rank = ranks.get(c)
            if rank is not None:
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(heap, rank)
                index[rank].append(at[a:b])

    enlist(np.arange(n))
    while heap:
        rank = heapq.heappop(heap)
        found = index.pop(rank)
        at = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
        right = after[at]
        live = right < n
        at, right = at[live], right[live]
        live = (symbols[at] == vocabulary.left[rank]) & (symbols[right] == vocabulary.right[rank])
        at, right = at[live], right[live]
        if not len(at):
            continue
        if vocabulary.left[rank] == vocabulary.right[rank]:
            # In a run of one symbol the pairs overlap: every other one from the left is merged.
            head = np.concatenate([[True], right[:-1] != at[1:]])
            odd = (np.arange(len(at)) - np.flatnonzero(head)[np.cumsum(head) - 1]) % 2 == 1
            at, right = at[~odd], right[~odd]
        symbols[at] = vocabulary.merged[rank]
        symbols[right] = -1
        beyond = after[right]
        after[at] = beyond
        inside = beyond < n
        before[beyond[inside]] = at[inside]
        left = before[at]
        enlist(np.unique(np.concatenate([at, left[left >= 0]])))
    return symbols


def _spread(offset: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The places offset[i]:offset[i + 1] of each i in `which`, one after another."""
    n = offset[which + 1] - offset[which]
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - offset[which], n)


class _Block:
    """Encodes texts of a block; knows the tokens of the pre-tokens it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.find = regex.compile(PRE_TOKEN).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.fresh: list[str] = []
        self.tokens, self.offset = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def cut(self, text: str) -> np.ndarray:
        """The places of a text's pre-tokens."""
        if self.special and any(x in text for x in self.vocabulary.special):
            words = []
            for part in self.special.split(text):
                words += [part] if part in self.vocabulary.special else self.find(part)
        else:
            words = self.find(text)
        place = self.place
        try:
            return np.fromiter(map(place.__getitem__, words), np.int32, len(words))
        except KeyError:
            for word in words:
                if word not in place:
                    place[word] = len(place)
                    self.fresh.append(word)
            return np.fromiter(map(place.__getitem__, words), np.int32, len(words))

    def learn(self) -> None:
        """Encode the pre-tokens met since the last call."""
        if not self.fresh:
            return
        special = self.vocabulary.special
        spelled = [b"" if w in special else w.encode() for w in self.fresh]
        n = np.array([len(x) for x in spelled])
        symbols = self.vocabulary.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        end = np.zeros(len(symbols), bool)
        end[np.cumsum(n)[n > 0] - 1] = True
        merged = merge_all(symbols, end, self.vocabulary)
        kept = merged >= 0
        counts = np.bincount(np.repeat(np.arange(len(n)), n)[kept], minlength=len(n))
        tokens = merged[kept]
        for i in np.flatnonzero(n == 0):
            tokens = np.insert(tokens, counts[:i].sum(), special[self.fresh[i]])
            counts[i] = 1
        self.tokens = np.concatenate([self.tokens, tokens])
        self.offset = np.concatenate([self.offset, self.offset[-1] + np.cumsum(counts)])
        self.fresh = []

    def encode(self, places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        self.learn()
        every = np.concatenate(places) if places else np.zeros(0, np.int64)
        size = np.diff(self.offset)[every] if len(every) else every
        row = np.repeat(np.arange(len(places)), [len(p) for p in places])
        return self.tokens[_spread(self.offset, every)] if len(every) else every, np.bincount(row, size, len(places)).astype(np.int64)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), decoded: bool = False) -> DataFrame:
    """(id, n_tokens, ids) and the columns `keep` of every row; ids is the binary string of the ids as little-endian unsigned 32-bit integers.

    vocabulary: path of a byte-level BPE file in the tokenizers JSON format, read by the driver and broadcast. Special
    strings of the file are single tokens wherever they stand in a text, and nothing is added, cut or padded. A null or
    empty text has no ids. Texts are whole: a text of any length is encoded in one piece. Other columns are not read.
    decoded: also the text that the ids stand for, as decode() gives it, by the same worker.
    """
    kept = docs.select(*keep).schema.fields if keep else []
    more = [StructField("decoded", StringType())] if decoded else []
    schema = StructType([StructField("id", LongType()), StructField("n_tokens", LongType()), StructField("ids", BinaryType()), *kept, *more])
    held = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(parse(held.value))
        held_rows: list[pa.RecordBatch] = []
        places: list[np.ndarray] = []
        size = 0

        def done() -> pa.RecordBatch:
            tokens, counts = block.encode(places)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]) * 4, pa.int64())
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, offsets.buffers()[1], pa.py_buffer(tokens.astype("<u4").tobytes())])
            rows = pa.concat_batches(held_rows)
            columns = [rows.column(0), pa.array(counts, pa.int64()), packed.cast(pa.binary()), *rows.columns[2:]]
            if decoded:
                ends = np.cumsum(counts)
                columns.append(pa.array([spelled(block.vocabulary, tokens[a:b]) for a, b in zip(ends - counts, ends, strict=True)], pa.string()))
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in slices(batches, 1):
            held_rows.append(batch)
            for text in batch.column(1).to_pylist():
                places.append(block.cut(text or ""))
                size += len(text or "")
            if size >= BLOCK_CHARS:
                yield done()
                held_rows, places, size = [], [], 0
                if len(block.place) > KEPT_TOKENS:
                    block.forget()
        if held_rows:
            yield done()

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"), *keep), run, schema)


def spelled(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of some ids, bytes that are not UTF-8 replaced."""
    return vocabulary.data[_spread(vocabulary.offset, ids)].tobytes().decode("utf-8", "replace")


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """The rows of `encoded` with a column `decoded`: the text of the ids, bytes that are not UTF-8 replaced.

    ids_col: binary as encode() gives it. Null ids give a null text; special tokens are spelled out.
    """
    held = encoded.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text(encoding="utf-8"))
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = parse(held.value)
        for batch in slices(batches, at):
            texts = []
            for packed in batch.column(at).to_pylist():
                texts.append(None if packed is None else spelled(v, np.frombuffer(packed, "<u4").astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return map_arrow(encoded, run, schema)

