"""Quality and toxicity of documents by weak supervision.

Overlapping heuristic labellers vote on every document, or abstain. Expectation-maximisation over the counts of all vote
patterns of the corpus estimates each labeller's accuracies and the classes' shares without any labels; the posterior of
a document's pattern then labels a bounded sample, on which a linear scorer over hashed words and shape features is fitted.
The scorer, not the votes, judges every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import flat, lists, map_arrow, mix, prefix_hashes, slices, span_sums, Words, words
from ._text import _WORDS as _POWERS

#: Documents that the scorer is fitted on at most (about), and labelled documents that the toxic lexicon is counted on.
SAMPLE, LABELLED = 12_000, 20_000
#: Documents of the sample that a word must stand in to have a weight.
LEAST_EXAMPLES = 20
#: Entries of the counted lexicon, the documents of the toxic class that one must stand in, and the letters of a word's stem.
LEXICON, LEXICON_LEAST, STEM = 500, 12, 4
#: Hashed features; the last SHAPES of them are for shape features.
BUCKETS, SHAPES = 1 << 15, 256
# Frequent words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is it that was for on are as with be by this not or from at an but have which they you were "
    "le la les de des du et un une est en que qui dans pour pas sur au avec ce il sont ne se par plus "
    "der die das und ist von den mit zu dem nicht ein eine als auch auf sich im für an werden "
    "el los las que en una por con del se al su para como más pero sus este ya"
).split()
# Common insults.
INSULTS = (
    "idiot idiots moron morons stupid loser losers scum trash worthless pathetic clown disgusting dumb fool imbecile retard bastard bitch "
    "shit fuck fucking asshole crap jerk filth vermin connard connasse salaud imbécile abruti crétin débile ordure arschloch scheiße "
    "scheisse trottel dummkopf abschaum hurensohn vollidiot idiota imbécil estúpido estúpida cabrón gilipollas puta mierda basura"
).split()

_LETTER, _UPPER, _MARK, _PIPE, _STOP = (np.zeros(256, np.int64) for _ in range(5))
_UPPER[65:91] = 1
_LETTER[65:91] = _LETTER[97:123] = 1
_LETTER[192:] = 1
_BODY, _SPACE = _LETTER.copy(), np.zeros(256, bool)
_BODY[128:] = _BODY[48:58] = 1
for _c in " \t\n\r\f\v":
    _SPACE[ord(_c)] = True
for _c in "#$%&*!<>{}[]\\^~_=+@":
    _MARK[ord(_c)] = 1
_PIPE[ord("|")] = 1
for _c in ".!?":
    _STOP[ord(_c)] = 1

#: What is known beforehand of any labeller that votes, as so many documents of each class: P(says bad) of bad and good ones.
PRIOR, PRIOR_DOCUMENTS = np.array([0.3, 0.002]), 20.0
QUALITY_LABELLERS = ("shouting", "marks", "table", "function words", "repeated lines", "vocabulary", "sentences", "letters", "bare tokens", "stutter", "runs")
TOXIC_LABELLERS = ("insults", "lexicon", "density")


def word_hashes(texts: list[str]) -> np.ndarray:
    return np.unique(words(*flat(pa.array(texts, pa.large_string()))).hash)


def _within(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_) or not len(values):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


@dataclass
class Profile:
    """Shape measures of some texts, and their distinct words as (row, hash)."""

    measures: dict[str, np.ndarray]
    row: np.ndarray
    word: np.ndarray


def _repeated(data: np.ndarray, w: Words) -> np.ndarray:
    """Words in lines that stand in their text before."""
    n = len(w.counts)
    if not len(w.hash):
        return np.zeros(n, np.int64)
    line = np.searchsorted(np.flatnonzero(data == 10), w.start)
    row = w.row
    first = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (row[1:] != row[:-1])]))
    end = np.append(first[1:], len(line))
    key = span_sums(w.hash, first, end, _POWERS[1])
    order = np.lexsort((first, key, row[first]))
    again = np.zeros(len(first), bool)
    again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (row[first[order[1:]]] == row[first[order[:-1]]])
    return np.bincount(row[first], np.where(again, end - first, 0), n)


def _bare_tokens(data: np.ndarray, offsets: np.ndarray, w: Words) -> np.ndarray:
    """Tokens between white space that hold no word."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cut = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[cut] = solid[cut]
    token = np.cumsum(first)
    own = token[w.start] if len(w.start) else np.zeros(0, np.int64)
    row = w.row
    new = np.concatenate([np.ones(min(1, len(own)), bool), own[1:] != own[:-1]])
    return _sums(first.astype(np.int64), offsets) - np.bincount(row[new], minlength=len(offsets) - 1)


@dataclass
class Lexicon:
    """Hashes of words, and of the first STEM letters of words, that stand in toxic texts."""

    words: np.ndarray
    stems: np.ndarray

    @staticmethod
    def of(words: list[str], stems: list[str]) -> Lexicon:
        return Lexicon(word_hashes(words), word_hashes(stems))

    def holds(self, data: np.ndarray, w: Words) -> np.ndarray:
        return _within(self.words, w.hash) | (_within(self.stems, prefix_hashes(data, w, STEM)) if len(self.stems) else False)


def profile(texts: pa.Array, insults: np.ndarray, lexicon: Lexicon) -> Profile:
    data, offsets = flat(texts)
    w = words(data, offsets)
    n_words = w.counts
    row = w.row
    order = np.lexsort((w.hash, row))
    r, h = row[order], w.hash[order]
    new = np.concatenate([np.ones(min(1, len(r)), bool), (r[1:] != r[:-1]) | (h[1:] != h[:-1])])
    r, h = r[new], h[new]
    letters = np.maximum(1, _sums(_LETTER[data], offsets))
    size = np.maximum(1, np.diff(offsets))
    some = np.maximum(1, n_words)
    return Profile(
        {
            "words": n_words,
            "upper": _sums(_UPPER[data], offsets) / letters,
            "marks": _sums(_MARK[data], offsets) / size,
            "pipes": _sums(_PIPE[data], offsets) / some,
            "function": _sums(_within(_STOP_HASHES, w.hash), w.offset) / some,
            "repeated": _repeated(data, w) / some,
            "distinct": np.bincount(r, minlength=len(n_words)) / some,
            "richness": np.bincount(r, minlength=len(n_words)) / np.sqrt(some),
            "stops": _sums(_STOP[data], offsets) / some,
            "letters": _sums(_BODY[data], offsets) / np.maximum(1, _sums((~_SPACE[data]).astype(np.int64), offsets)),
            "bare": _bare_tokens(data, offsets, w) / some,
            "stutter": np.bincount(row[1:][(w.hash[1:] == w.hash[:-1]) & (row[1:] == row[:-1])], minlength=len(n_words)) / some,
            "runs": np.bincount(row[2:][(w.hash[2:] == w.hash[1:-1]) & (w.hash[2:] == w.hash[:-2]) & (row[2:] == row[:-2])], minlength=len(n_words)) / some,
            "insults": _sums(_within(insults, w.hash), w.offset),
            "lexicon": _sums(lexicon.holds(data, w), w.offset),
        },
        r,
        h,
    )


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_STOP_HASHES = word_hashes(STOP_WORDS)
_INSULT_HASHES = word_hashes(INSULTS)


def votes(p: Profile) -> tuple[np.ndarray, np.ndarray]:
    """Vote patterns for quality and for toxicity: two bits for each labeller, the lower says bad, the upper says good.

    A labeller that is not sure, or for which a text is too short, sets neither: it abstains. A text without words has bad
    votes for its function words, vocabulary and sentences.
    """
    m = p.measures
    some, long, none = m["words"] >= 5, m["words"] >= 20, m["words"] == 0
    root = np.sqrt(np.maximum(1, m["words"]))
    types = m["distinct"] * m["words"]
    quality = [
        (some & (m["upper"] > 0.5), some & (m["upper"] < 0.2)),
        (m["marks"] > 0.06, some & (m["marks"] < 0.01)),
        (m["pipes"] > 0.1, some & (m["pipes"] < 0.02)),
        ((m["function"] < 0.01) & long | none, long & (m["function"] > 0.05)),
        ((m["repeated"] > 0.5) & long, long & (m["repeated"] < 0.2)),
        ((types < root) & long | none, long & (types > 2 * root)),
        ((m["stops"] < 0.004) & long | none, long & (m["stops"] > 0.01)),
        ((m["letters"] < 0.9) & long, long & (m["letters"] > 0.94)),
        (m["bare"] > 0.15, some & (m["bare"] < 0.02)),
        ((m["stutter"] > 0.3) & long, long & (m["stutter"] < 0.1)),
        ((m["runs"] > 0.2) & long, long & (m["runs"] < 0.05)),
    ]
    said = m["insults"] + m["lexicon"]
    toxic = [(m["insults"] >= 1, some & (said == 0)), (m["lexicon"] >= 1, some & (said == 0)), (said > 0.004 * m["words"], long & (said < 0.0005 * m["words"]))]
    return tuple(sum((bad | good << 1).astype(np.int64) << 2 * i for i, (bad, good) in enumerate((b.astype(np.int64), (g & ~b).astype(np.int64)) for b, g in x)) for x in (quality, toxic))


def said_of(pattern: np.ndarray, labellers: int) -> tuple[np.ndarray, np.ndarray]:
    """(bad, good) votes of patterns, a column for each labeller."""
    at = 2 * np.arange(labellers)
    return pattern[:, None] >> at & 1, pattern[:, None] >> at + 1 & 1


@dataclass
class LabelModel:
    """Share of the bad class, and for each labeller P(says bad | it votes, class) with classes bad, good."""

    bad: float
    rate: np.ndarray

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        """P(bad | votes) of vote patterns."""
        bad, good = said_of(pattern, len(self.rate))
        score = bad @ np.log(self.rate) + good @ np.log(1 - self.rate) + np.log([self.bad, 1 - self.bad])
        return 1 / (1 + np.exp(np.clip(score[:, 1] - score[:, 0], -700, 700)))


def label_model(pattern: np.ndarray, count: np.ndarray, labellers: int, turns: int = 500) -> LabelModel:
    """EM over distinct vote patterns and their counts, started from the documents with a bad vote.

    Every accuracy is the votes' own, but for PRIOR, which weighs as much as PRIOR_DOCUMENTS documents of each class
    whatever the number of documents. Abstentions tell nothing. Without documents the model is the prior.
    """
    bad, good = said_of(pattern, labellers)
    p = np.where(bad.any(axis=1), 0.9, 0.02)
    model = LabelModel(0.1, np.tile(PRIOR, (labellers, 1)))
    for _ in range(turns):
        weight = np.stack([count * p, count * (1 - p)], axis=1)
        total = weight.sum(axis=0)
        says, voted = bad.T @ weight, (bad + good).T @ weight
        rate = np.clip((says + PRIOR * PRIOR_DOCUMENTS) / (voted + PRIOR_DOCUMENTS), 1e-6, 1 - 1e-6)
        model = LabelModel(float(np.clip(total[0] / max(1, count.sum()), 1e-4, 1 - 1e-4)), rate)
        was, p = p, model.posterior(pattern)
        if np.abs(was - p).max(initial=0) < 1e-7:
            break
    return model


def features(p: Profile, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all rows, number for each row): the distinct words, and the class of each shape measure."""
    shape = []
    for i, (_name, edges) in enumerate(_SHAPE_EDGES.items()):
        value = p.measures[_name]
        shape.append(BUCKETS - SHAPES + 16 * i + np.searchsorted(edges, value, "right"))
    word = (mix(p.word) % np.uint64(BUCKETS - SHAPES)).astype(np.int64)
    row = np.concatenate([p.row, np.tile(np.arange(n), len(shape))])
    bucket = np.concatenate([word, *shape])
    order = np.lexsort((bucket, row))
    row, bucket = row[order], bucket[order]
    new = np.concatenate([np.ones(min(1, len(row)), bool), (row[1:] != row[:-1]) | (bucket[1:] != bucket[:-1])])
    return bucket[new], np.bincount(row[new], minlength=n)


_SHAPE_EDGES = {
    "words": [1, 5, 20, 50, 200, 1000],
    "upper": [0.05, 0.1, 0.2, 0.35, 0.5, 0.7],
    "marks": [0.001, 0.01, 0.02, 0.04, 0.06, 0.1],
    "pipes": [0.001, 0.03, 0.1, 0.3],
    "function": [0.01, 0.03, 0.05, 0.08, 0.15],
    "repeated": [0.05, 0.15, 0.3, 0.6],
    "richness": [0.5, 1, 2, 4, 8],
    "stops": [0.004, 0.01, 0.02, 0.05],
    "letters": [0.5, 0.8, 0.9, 0.95],
    "bare": [0.02, 0.15, 0.4, 0.8],
    "stutter": [0.05, 0.15, 0.3, 0.6],
    "runs": [0.01, 0.05, 0.2, 0.5],
    "insults": [1, 2, 3, 6],
    "lexicon": [1, 2, 3, 6],
}


def fit_linear(bucket: np.ndarray, counts: np.ndarray, target: np.ndarray, turns: int = 100, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on binary features and soft targets, by full-batch AdaGrad. Without examples all weights are 0.

    A word that stands in fewer than LEAST_EXAMPLES documents of the sample has no weight: it would be learned by heart.
    """
    row = np.repeat(np.arange(len(counts)), counts)
    often = np.bincount(bucket, minlength=BUCKETS) >= min(LEAST_EXAMPLES, 1 + len(counts) // 50)
    often[BUCKETS - SHAPES :] = True
    used = often[bucket]
    row, bucket = row[used], bucket[used]
    # Shape features learn at the full rate, words at less than a tenth of it: they are many, and each tells little.
    rate = np.where(np.arange(BUCKETS) < BUCKETS - SHAPES, 0.04, 0.5)
    w, bias, n = np.zeros(BUCKETS), 0.0, max(1, len(counts))
    square, square_b = np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(turns):
        z = np.bincount(row, w[bucket], len(counts)) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        g = np.bincount(bucket, error[row], BUCKETS) / n + l2 * w
        gb = error.sum() / n
        square += g * g
        square_b += gb * gb
        w -= rate * g / np.sqrt(square)
        bias -= 0.5 * gb / np.sqrt(square_b)
    return w, bias


@dataclass
class Scorer:
    """Weights of the two heads, low quality and toxicity, and the lexicon that the features use."""

    weights: np.ndarray
    bias: np.ndarray
    lexicon: Lexicon

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probabilities (low quality, toxic) of each text."""
        n = len(texts)
        bucket, counts = features(profile(texts, _INSULT_HASHES, self.lexicon), n)
        row = np.repeat(np.arange(n), counts)
        z = np.stack([np.bincount(row, w[bucket], n) + b for w, b in zip(self.weights, self.bias, strict=True)], axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def toxic_lexicon(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, labelled: int = LABELLED) -> tuple[list[str], list[str]]:
    """(words, stems) that stand far more often in documents labelled toxic, from about `labelled` labelled documents.

    labels: doc_id, toxic; rows with a null in either are left out, and of several rows of one document the largest label
    counts. A stem is a word's first STEM letters. An entry stands in LEXICON_LEAST toxic documents or more, and 20 times
    as often there as in others; the LEXICON most frequent are taken, ties by spelling. Repeated document rows count each;
    null and empty texts hold no words. Empty tables, or labels of other documents, give no entries.
    """
    per_doc = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = per_doc.count()
    drawn = per_doc.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, labelled / max(1, n))))
    find = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            seen: dict[tuple[str, bool], list[int]] = {}
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = set(find((text or "").translate(_LOWER)))
                for entry in [(x, False) for x in own] + [(x, True) for x in {x[:STEM] for x in own if len(x) > STEM}]:
                    seen.setdefault(entry, [0, 0])[int(toxic > 0)] += 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.bool_()), *(pa.array([v[i] for v in seen.values()], pa.int64()) for i in (0, 1))], ["word", "stem", "clean", "toxic"])

    # The drawn labels are bounded by `labelled`.
    held = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).join(F.broadcast(drawn), "doc_id").select("toxic", "t")
    found = map_arrow(held, count, "word string, stem boolean, clean long, toxic long").groupBy("word", "stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    best = found.where((F.col("toxic") >= LEXICON_LEAST) & (F.col("toxic") > 20 * F.col("clean"))).orderBy(F.desc("toxic"), "word", "stem").limit(LEXICON)
    rows = best.collect()
    return [r.word for r in rows if not r.stem], [r.word for r in rows if r.stem]


def fit(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Scorer:
    """The scorer for a corpus. labels (doc_id, toxic): used for the toxic lexicon alone; without it there is none.

    Votes are counted over all documents; the linear weights come from about `sample` documents, drawn by a hash of their
    ids, with the label model's posteriors as targets. A null text counts as an empty one, repeated rows each count, and
    rows of one id (also a null one) are drawn together, so that equal tables give equal scorers. An empty table gives
    a scorer without weights. Other columns are not read.
    """
    lexicon = Lexicon.of(*toxic_lexicon(docs, labels, id_col, text_col)) if labels is not None else Lexicon.of([], [])
    held = docs.sparkSession.sparkContext.broadcast(lexicon)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in votes(profile(batch.column(1), _INSULT_HASHES, held.value))], ["quality", "toxic"])

    # One row for each pattern of votes: a few hundred, whatever the number of documents.
    counted = map_arrow(texts, vote, "quality long, toxic long").groupBy("quality", "toxic").count().toPandas()
    models = [label_model(counted[c].to_numpy(np.int64), counted["count"].to_numpy(float), n) for c, n in (("quality", len(QUALITY_LABELLERS)), ("toxic", len(TOXIC_LABELLERS)))]
    n = int(counted["count"].sum())

    def example(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            p = profile(batch.column(1), _INSULT_HASHES, held.value)
            bucket, counts = features(p, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(pa.array(v, pa.int64()) for v in votes(p)), lists(bucket, counts, pa.int32())], ["quality", "toxic", "bucket"])

    drawn = texts.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample / max(1, n))))
    rows = map_arrow(drawn, example, "quality long, toxic long, bucket array<int>").toArrow().combine_chunks()
    bucket = rows["bucket"].combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
    counts = np.diff(bucket.offsets.to_numpy()) if rows.num_rows else np.zeros(0, np.int64)
    heads = [fit_linear(bucket.flatten().to_numpy(), counts, m.posterior(rows[c].to_numpy())) for m, c in zip(models, ("quality", "toxic"), strict=True)]
    return Scorer(np.array([w for w, _ in heads], np.float32), np.array([b for _, b in heads]), lexicon)


def judge(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id, low_quality, toxic, keep) of every row: two probabilities, and whether both are below the threshold.

    A null or empty text, or one without words, has low quality 1 and is not kept. Whole texts are read. Repeated rows each
    have their row; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            s = held.value.scores(batch.column(1))
            none = words(*flat(batch.column(1))).counts == 0
            s[none] = [1.0, 0.0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s[:, 0]), pa.array(s[:, 1]), pa.array((s < threshold).all(axis=1))], ["id", "low_quality", "toxic", "keep"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")), run, "id long, low_quality double, toxic double, keep boolean")
