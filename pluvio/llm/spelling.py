"""Grouping of spelling variants by a rare-first prefix filter over positional bigrams.

Two words one edit apart keep all bigrams but two at most, so that of the three rarest bigrams of each, by one global order,
at least one is common and untouched, and stands at the same place or one further. The edit is then wholly to its right,
and what is to its left is alike, or the other way round. So each of a word's three rarest bigrams gives two keys, the word
up to its end and the word from its start on, and words meet by equality of these; the edit distance decides.

A key with many words is not met pair by pair: within the part of its words that may still differ the same holds again, so
that the key is cut by the three rarest bigrams of that part, as often as need be.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2, log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._graph import Scratch, shared
from ._text import lists
from .sql import LOWER, UPPER

#: Runs of these characters are words; of them A-Z alone are lower-cased.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Words of one key that meet pair by pair; larger keys are cut anew.
CROWD = 128
#: Bigrams that one edit can touch, and one more: so many are a word's prefix.
PREFIX = 3
#: Letters of a part with fewer bigrams than PREFIX, and of the words one edit longer.
_SHORT = PREFIX + 1


def words_of(text: Column) -> Column:
    """The array of a text's words, lower-cased over A-Z; empty for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(LETTERS), F.lit(0))


def misspelt(word: Column, doc_id: Column, every: int = 31) -> Column:
    """The word, or for one (document, word) in `every`, by a checksum, the word without one of its letters."""
    h = F.crc32(F.concat_ws(":", doc_id.cast("string"), word))
    at = (h % F.length(word)).cast("int")
    cut = F.concat(F.substring(word, 1, at), F.substring(word, at + 2, F.length(word)))
    return F.when(doc_id.isNotNull() & (h % every == 0), cut).otherwise(word)


def vocabulary(words: DataFrame, min_chars: int = 7, min_count: int = 2) -> DataFrame:
    """(word, n) of the column `word`: words of at least `min_chars` letters and `min_count` occurrences."""
    counted = words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _bigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code of every bigram of the words, one word after the other, and how many each word has."""
    letters = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    last = np.cumsum(lengths) - 1
    codes = np.append(letters[:-1] << 21 | letters[1:], 0)[: len(letters)]
    return np.delete(codes, last), lengths - 1


def _ranked(words: DataFrame) -> DataFrame:
    """(word, n, ranks): the place of each of a word's bigrams in the global order, the rarest first.

    The order has a row for each pair of letters of the alphabet at most, which bounds what the driver takes and sends.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, n = np.unique(_bigrams(batch.column("word"))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["code", "f"])

    counts = words.select("word").mapInArrow(count, "code long, f long").groupBy("code").agg(F.sum("f").alias("f")).collect()
    ordered = sorted((r.f, r.code) for r in counts)
    codes = np.array([c for _, c in ordered], np.int64)
    by_code = np.argsort(codes)
    sent = words.sparkSession.sparkContext.broadcast((codes[by_code], by_code.astype(np.int32)))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = sent.value
        for batch in batches:
            codes, n = _bigrams(batch.column("word"))
            ranks = lists(place[np.searchsorted(known, codes)] if len(codes) else place[:0], n, pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, ranks], ["word", "n", "ranks"])

    return words.select("word", "n").mapInArrow(rank, "word string, n long, ranks array<int>")


def _cut(items: DataFrame) -> DataFrame:
    """Items cut by the three rarest bigrams of the part of the word, from lo to hi, that may still differ.

    An item with a part of up to four letters also stays, as `final`: words with fewer bigrams than three meet all those.
    """
    part = F.col("hi") - F.col("lo")
    places = F.when(part >= _SHORT, F.sequence(F.col("lo"), F.col("hi") - 2)).otherwise(F.array().cast("array<int>"))
    rare = F.slice(F.array_sort(F.transform(places, lambda p: F.struct(F.get("ranks", p).alias("rank"), p.alias("p")))), 1, PREFIX)
    at = lambda lo, hi, final: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), F.lit(final).alias("final"))
    beside = F.flatten(F.transform(rare, lambda x: F.array(at(x["p"] + 2, F.col("hi"), False), at(F.col("lo"), x["p"], False))))
    same = F.when(part <= _SHORT, F.array(at(F.col("lo"), F.col("hi"), True))).otherwise(F.array().cast("array<struct<lo:int,hi:int,final:boolean>>"))
    return items.select("word", "n", "ranks", F.explode(F.concat(beside, same)).alias("x")).select("word", "n", "ranks", "x.*").distinct()


def _with_keys(items: DataFrame) -> DataFrame:
    """Items with two hashes of what is fixed of the word: up to lo, and from hi on."""
    left, right = F.col("word").substr(F.lit(1), F.col("lo")), F.col("word").substr(F.col("hi") + 1, F.length("word"))
    return items.withColumns({f"k{i}": F.xxhash64(F.lit(i), left, right, "final") for i in (1, 2)})


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, n, other, other_n): every ordered pair of words (word, n) that are one edit apart."""
    key = ["k1", "k2"]
    with Scratch(words.sparkSession) as scratch:
        ranked = scratch.stored(_ranked(words))
        todo, found = ranked.withColumns({"lo": F.lit(0), "hi": F.length("word")}), None
        while True:
            items = scratch.stored(_with_keys(_cut(todo)))
            sizes = items.groupBy(*key).agg(F.count("*").alias("size"), F.first("final").alias("last")).where("size > 1")
            sizes = scratch.stored(sizes)
            met = items.drop("ranks").join(sizes.where((F.col("size") <= crowd) | F.col("last")).select(*key), key)
            met = met.select(*key, "word", "n")
            other = met.select(*key, F.col("word").alias("other"), F.col("n").alias("other_n"))
            close = F.abs(F.length("word") - F.length("other")) <= 1
            apart = (F.col("word") < F.col("other")) & close & (F.levenshtein("word", "other", 1) == 1)
            pairs = met.join(other, key).where(apart).select("word", "n", "other", "other_n").distinct()
            found = scratch.stored(pairs if found is None else found.unionByName(pairs).distinct())
            crowds = sizes.where((F.col("size") > crowd) & ~F.col("last")).select(*key)
            if crowds.isEmpty():
                break
            todo = items.join(crowds, key, "left_semi").drop(*key, "final")
        turned = found.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
        return shared(found.unionByName(turned))


def variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7, min_count: int = 2, times: int = 10, every: int = 31, crowd: int = CROWD) -> DataFrame:
    """(word, n, n_near, form, form_n, root): the words of whole texts, and which more frequent spelling each stands for.

    Words are as `words_of` and `misspelt` say; null and empty texts have none, and a null id spells all words as they
    stand. n: occurrences. n_near: how many words are one edit apart. form: of these the most frequent, ties to the first in
    code-point order, if it is `times` as frequent as the word; else null. root: the last of the forms from word to word,
    the word itself if it has none. Rows that repeat an id and a text count as often as they stand. Other columns are not
    read. An empty table gives no rows.
    """
    # No letter is ever added, so that shorter runs are no words, and need no checksum.
    told = documents.select(F.col(id_col).alias("id"), F.explode(words_of(F.col(text_col))).alias("word")).where(F.length("word") >= min_chars)
    with Scratch(documents.sparkSession) as scratch:
        words = scratch.stored(vocabulary(told.select(misspelt(F.col("word"), F.col("id"), every).alias("word")), min_chars, min_count))
        near = near_words(words, crowd)
        first = F.struct((-F.col("other_n")).alias("order"), "other")
        best = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(first).alias("best"))
        forms = best.withColumn("form_n", -F.col("best.order")).where(F.col("form_n") >= times * F.col("n")).select("word", F.col("best.other").alias("form"), "form_n")
        forms = scratch.stored(forms)
        roots = forms.select("word", F.col("form").alias("root"))
        # Each form is `times` as frequent as the last, which bounds the steps; every turn doubles them.
        most = words.agg(F.max("n")).first()[0] or 1
        steps = log10(max(most, 1)) / log10(times) + 1 if times > 1 else most
        for _ in range(ceil(log2(steps)) if steps > 1 else 0):
            further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
            roots = scratch.stored(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        out = words.join(best.select("word", "n_near"), "word", "left").join(forms, "word", "left").join(roots, "word", "left")
        return shared(out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")))
