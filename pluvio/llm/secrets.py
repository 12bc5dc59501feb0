"""Secrets in texts: fixed credential patterns, and strings that no text would give, by a battery of randomness tests.

Candidates are long runs of key characters. For the alphabet that its characters suggest, each is put to three tests:
chi-squared uniformity of the alphabet, the Wald-Wolfowitz runs test about the alphabet's middle, and lag-one serial
correlation. How the battery comes out on strings that are no secrets is known from the corpus itself: a character model
of its ordinary tokens writes strings of each alphabet and length, on which the battery's result has a mean and a spread.
Against that null, "written like the corpus' text", each candidate has a p-value, and the Benjamini-Yekutieli procedure over
all candidates of an alphabet and length class takes those that are reported: so the share of false secrets among
them is bounded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import erfc, lgamma, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import Scratch, shared
from ._text import map_arrow, slices

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
ASSIGN_LEAST = 6
#: Kinds in the order in which spans that start together stand.
KINDS = ("assign", "access", "hex", "random")
#: Least length of a candidate, by the size of its alphabet: below, the tests have too little power to tell it from text.
LEAST = 20
FALSE_DISCOVERY = 0.05
#: Results of the battery are counted in classes of this width, up to so many; see disorder().
CLASS_WIDTH, CLASSES = 0.1, 100
#: Strings that the character model writes for each alphabet and length class.
NULL_STRINGS = 400
#: Least spread of the battery's result on ordinary strings: real names vary more than a model's.
LEAST_SPREAD = 0.25
#: Strings of ordinary tokens that the character model supposes beforehand of every pair of characters.
LITTLE = 0.02

#: Alphabets by name, in the order of inference: the first that holds all characters of a string is taken.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "upper-hex": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64-url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_PLACES = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS.items()}


#: Characters of candidates, in the order of the character model.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
_LETTER_AT = {c: i for i, c in enumerate(LETTERS)}


def infer_encoding(text: str) -> str | None:
    """The first alphabet that holds all characters of a candidate; None if none does, or if it has no letter."""
    body = text.rstrip("=")
    if not any(c.isalpha() for c in body):
        return None
    own = set(body)
    return next((name for name, places in _PLACES.items() if own <= places.keys()), None)


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def chi_squared_tail(x: float, k: int) -> float:
    """P(X >= x) for the chi-squared distribution with k degrees of freedom, by the regularised gamma function."""
    a, x = k / 2, x / 2
    if x <= 0:
        return 1.0
    scale = np.exp(a * log(x) - x - lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-12:
            n += 1
            term *= x / n
            total += term
        return float(max(0.0, 1 - total * scale))
    b = x + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 300):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-12:
            break
    return float(min(1.0, scale * h))


def randomness(text: str, encoding: str) -> tuple[float, float, float]:
    """p-values of uniformity, runs and serial correlation; near 0 where the text is not random over the alphabet."""
    places = _PLACES[encoding]
    x = np.array([places[c] for c in text.rstrip("=")], float)
    n, size = len(x), len(places)
    # Cells of neighbouring letters, so that each is expected five times or so.
    cells = max(2, min(size, n // 5))
    seen = np.bincount((x * cells / size).astype(int), minlength=cells)
    width = np.bincount((np.arange(size) * cells / size).astype(int), minlength=cells)
    expected = n * width / size
    uniform = chi_squared_tail(float(((seen - expected) ** 2 / expected).sum()), cells - 1)
    # Kinds of characters: digits, lower and upper case, marks.
    kinds = np.array([_kind(c) for c in ALPHABETS[encoding]])
    share = np.bincount(kinds, minlength=4) * n / size
    seen = np.bincount(kinds[x.astype(int)], minlength=4)[share > 0]
    share = share[share > 0]
    uniform = min(1.0, 2 * min(uniform, chi_squared_tail(float(((seen - share) ** 2 / share).sum()), len(share) - 1)))
    high = x >= size / 2
    up, down = int(high.sum()), int((~high).sum())
    if up and down:
        mean = 2 * up * down / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs = erfc(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / sqrt(2 * var)) if var > 0 else 1.0
    else:
        runs = 2.0 ** (1 - n)
    d = x - x.mean()
    r = float((d[1:] * d[:-1]).sum() / (d * d).sum()) if d.any() else 1.0
    serial = erfc(abs(r + 1 / n) * sqrt(n) / sqrt(2))
    return uniform, runs, serial


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, rank of kind, end) of the fixed patterns' matches, leftmost and non-overlapping for each kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST] if "=" in text or ":" in text else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def shortest(length: int) -> int:
    """The least length of a class."""
    n = int(LEAST * 1.5**length)
    return n if length_class(n) == length else n + 1


def length_class(n: int) -> int:
    """Lengths 20-29, 30-44, 45-66, ...: each class is half as long again."""
    return int(log(max(n, LEAST) / LEAST) / log(1.5))


def disorder(text: str, encoding: str) -> float:
    """What the battery makes of a string: the logarithm of Fisher's sum over its p-values. Small where it is random."""
    return log(2 - 2 * sum(log(max(p, 1e-300)) for p in randomness(text, encoding)))


def class_of(x: float) -> int:
    return max(0, min(CLASSES - 1, int(x / CLASS_WIDTH)))


def _styled(text: str, letters: str, i: int, rng: np.random.Generator) -> str:
    """A string as names are written, if the alphabet has what that takes: as it is, with large letters or marks where
    words begin, or with digits at its end."""
    style, out = i % 4, list(text)
    begins = np.cumsum(rng.integers(3, 10, len(out)))
    begins = begins[begins < len(out)].tolist()
    marks = [c for c in letters if not c.isalnum()]
    if style in (1, 3) and any(c.islower() for c in letters) and any(c.isupper() for c in letters):
        for k in begins:
            out[k] = out[k].upper()
    if style in (2, 3) and marks:
        mark = marks[i // 4 % len(marks)]
        for k in begins:
            out[k - (style == 3)] = mark
    if i // 4 % 2 and "9" in letters:
        n = int(rng.integers(1, 5))
        out[-n:] = [str(d) for d in rng.integers(0, 10, n)]
    return "".join(out)


@dataclass
class TextModel:
    """How ordinary tokens go on from character to character: counts[i, j] of LETTERS[j] after LETTERS[i]."""

    counts: np.ndarray

    def strings(self, encoding: str, length: int, n: int, seed: int) -> list[str]:
        """n strings over the alphabet, written as the corpus writes; an alphabet without small letters gets large ones."""
        rng, letters = np.random.default_rng(seed), ALPHABETS[encoding]
        counts = self.counts
        if not any(c.islower() for c in letters):
            at = np.array([_LETTER_AT[c.upper()] for c in LETTERS])
            folded = np.zeros_like(counts)
            np.add.at(folded, (at[:, None], at[None, :]), counts)
            counts = folded
        own = np.array([_LETTER_AT[c] for c in letters])
        step = counts[np.ix_(own, own)]
        step = step + LITTLE * (1 + step.sum(axis=0)) / (len(own) + step.sum()) * (1 + step.sum(axis=1, keepdims=True))
        start = step.sum(axis=0) / step.sum()
        step = np.cumsum(step / step.sum(axis=1, keepdims=True), axis=1)
        state = rng.choice(len(own), n, p=start)
        out = [state]
        for _ in range(length - 1):
            state = np.minimum((step[state] < rng.random(n)[:, None]).sum(axis=1), len(own) - 1)
            out.append(state)
        table = np.array(list(letters))
        rows = table[np.stack(out, axis=1)]
        return [_styled("".join(row), letters, i, rng) for i, row in enumerate(rows)]

    def null(self, encoding: str, length: int) -> tuple[float, float]:
        """Mean and spread of disorder() on such strings."""
        x = [disorder(t, encoding) for t in self.strings(encoding, length, NULL_STRINGS, seed=length)]
        return float(np.mean(x)), max(LEAST_SPREAD, float(np.std(x)))


_BASE = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())]))
_TESTED = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.string()), ("length", pa.int32()), ("result", pa.int32())]))
_FOUND = "id long, base array<struct<start:int,rank:int,end:int>>, tested array<struct<start:int,end:int,encoding:string,length:int,result:int>>, pairs array<long>"


def _pair_counts(text: str) -> np.ndarray:
    """Pairs of neighbouring characters in the text's ordinary tokens, those too short to be candidates."""
    data = np.frombuffer(text.encode(), np.uint8)
    at = _CODE[data]
    inside = at >= 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    short = (end - start >= 4) & (end - start < LEAST)
    keep = np.repeat(short, end - start)
    place = np.flatnonzero(inside)[keep]
    row = np.repeat(np.arange(len(start)), end - start)[keep]
    same = row[1:] == row[:-1]
    n = len(LETTERS)
    return np.bincount(at[place[:-1][same]] * n + at[place[1:][same]], minlength=n * n)


_CODE = np.full(256, -1)
for _c, _i in _LETTER_AT.items():
    _CODE[ord(_c)] = _i


def candidates(docs: DataFrame) -> DataFrame:
    """(id, base, tested, pairs) of every row of docs (id, text): spans of the fixed patterns, and candidates that are not
    inside them with what the battery makes of them. pairs is null but in one more row of each task, which has the task's
    counts of character pairs and a null in all else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(len(LETTERS) ** 2, np.int64)
        schema = pa.schema([("id", pa.int64()), ("base", _BASE), ("tested", _TESTED), ("pairs", pa.list_(pa.int64()))])
        for batch in slices(batches, 1):
            base, tested = [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                spans = sorted(base_spans(text))
                base.append([{"start": s, "rank": k, "end": e} for s, k, e in spans])
                more = []
                for m in CANDIDATE.finditer(text):
                    s, e = m.span()
                    if any(a <= s and e <= b for a, _, b in spans) or not (encoding := infer_encoding(m.group())):
                        continue
                    more.append({"start": s, "end": e, "encoding": encoding, "length": length_class(e - s), "result": class_of(disorder(m.group(), encoding))})
                tested.append(more)
                pairs += _pair_counts(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, _BASE), pa.array(tested, _TESTED), pa.nulls(batch.num_rows, pa.list_(pa.int64()))], schema=schema)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, _BASE), pa.nulls(1, _TESTED), pa.array([pairs.tolist()], pa.list_(pa.int64()))], schema=schema)

    return map_arrow(docs, run, _FOUND)


def reported_classes(counts: dict[tuple[str, int, int], int], model: TextModel, rate: float = FALSE_DISCOVERY) -> dict[tuple[str, int], int]:
    """For each (encoding, length class) the number of result classes, from the most random on, that are reported: by the
    Benjamini-Yekutieli step-up procedure over the p-values of its candidates under the null of the character model."""
    out = {}
    for encoding, length in {(e, n) for e, n, _ in counts}:
        own = sorted((c, n) for (e, k, c), n in counts.items() if (e, k) == (encoding, length))
        mean, spread = model.null(encoding, shortest(length))
        total = sum(n for _, n in own)
        allowed = rate / (log(total) + 0.5772 + 1 / (2 * total))
        out[encoding, length], rank = 0, 0
        for c, n in own:
            rank += n
            # The upper end of the class, so that no p-value is understated.
            p = erfc((mean - (c + 1) * CLASS_WIDTH) / spread / sqrt(2)) / 2
            if p <= allowed * rank / total:
                out[encoding, length] = c + 1
    return out


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FALSE_DISCOVERY) -> DataFrame:
    """(id, base, spans) of every row: arrays of (start, rank, end) in code points, end exclusive, by start, then kind.

    rank is a kind's place in KINDS. base holds the fixed patterns' matches; spans holds these and the strings reported by
    the battery (kind "random"), which may hold or overlap a base span but do not lie inside one. Of the strings reported
    for an alphabet and length class, a share of `rate` at most is expected to be text. A null text is empty and has none.
    Repeated rows each have their row, also with null ids; whole texts of any length are read, once; an empty table gives
    no rows. Other columns are not read. What comes to the driver is a matrix of character pairs, and one number for each
    alphabet, length class and result: a few thousand numbers whatever the corpus holds.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    with Scratch(docs.sparkSession) as scratch:
        found = scratch.stored(candidates(texts))
        at = F.posexplode("pairs").alias("at", "n")
        pairs = found.where("pairs is not null").select(at).groupBy("at").agg(F.sum("n").alias("n")).where("n > 0").collect()
        matrix = np.zeros(len(LETTERS) ** 2)
        for r in pairs:
            matrix[r.at] = r.n
        counts = found.where("size(tested) > 0").select(F.explode("tested").alias("x")).groupBy("x.encoding", "x.length", "x.result").count().collect()
        limit = reported_classes({(r[0], r[1], r[2]): r[3] for r in counts}, TextModel(matrix.reshape(len(LETTERS), -1)), rate)
        limits = F.create_map(*[F.lit(y) for (e, n), c in sorted(limit.items()) for y in (f"{e}:{n}", c)]) if limit else F.create_map().cast("map<string,int>")
        keep = F.filter("tested", lambda x: x["result"] < F.element_at(limits, F.concat_ws(":", x["encoding"], x["length"])))
        more = F.transform(keep, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index("random")).alias("rank"), x["end"].alias("end")))
        return shared(found.where("pairs is null").select("id", "base", F.array_sort(F.concat("base", more)).alias("spans")))
