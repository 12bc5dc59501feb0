"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pluvio.llm import registry, spelling

DOC = "doc_id long, text string"


def _words(rows, every=31):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if i is not None and h % every == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def _near(words):
    near, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
            if (short := w[:i] + w[i + 1 :]) in words:
                near[w].add(short)
                near[short].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    return near


def _variants(rows):
    words = _words(rows)
    near = _near(words)
    best = {w: min(near[w], key=lambda o: (-words[o], o)) for w in words if near[w]}
    forms = {w: o for w, o in best.items() if words[o] >= 10 * words[w]}
    out = {}
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out[w] = (n, len(near[w]), forms.get(w), words[forms[w]] if w in forms else None, root)
    return out


def _got(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("crowd", [128, 2])
def test_near_words_against_all_pairs(spark, crowd):
    """Repeated letters, common ends and starts, edits at either end, and crowds that must be cut many times."""
    rng = random.Random(3)
    words = {"a" * n for n in range(7, 12)} | {"abcdefg" + "".join(rng.choice("xyz") for _ in range(rng.randrange(6))) for _ in range(150)}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randrange(7, 11))) for _ in range(200)}
    words |= {"éèlégance" + c for c in ("", "s", "ÿ")} | {"".join(rng.choice("xyz") for _ in range(rng.randrange(5))) + "qrstuvw" for _ in range(100)}
    df = spark.createDataFrame([(w, i) for i, w in enumerate(sorted(words), 2)], "word string, n long")
    got = sorted((r.word, r.other) for r in spelling.near_words(df, crowd).collect())
    assert got == sorted((w, o) for w, near in _near(words).items() for o in near)


def test_forms_and_roots(spark):
    rows = [(i, "Colourful colourfull") for i in range(40)] + [(100 + i, "colorful " * 25) for i in range(200)] + [(500, "colourfulll " * 2 + "unrelated unrelated; sixsix sixsix, loneword")]
    docs = spark.createDataFrame(rows, DOC)
    got = _got(spelling.variants(docs, crowd=3))
    assert got == _variants(rows)
    assert got["colourfull"][4] == "colourfull" and got["colourful"][2] == "colorful" and got["colourfulll"][2] == "colourfull"
    assert got["colourfulll"][4] == "colourfull"


def test_chains_of_forms(spark):
    counts = {"abcdefgh": 20000, "abcdefgx": 2000, "abcdefyx": 200, "abcdezyx": 20, "abcdwzyx": 2}
    docs = spark.createDataFrame([(None, f"{w} " * n) for w, n in counts.items()], DOC)
    got = _got(spelling.variants(docs))
    assert {w: v[4] for w, v in got.items()} == dict.fromkeys(counts, "abcdefgh")
    assert got["abcdwzyx"] == (2, 1, "abcdezyx", 20, "abcdefgh")


def test_odd_texts(spark):
    long = "z" * 200_000
    rows = [(1, None), (2, ""), (3, "123 ... 456"), (4, long + " " + long), (5, "Été×÷ÿab Été×÷ÿab été×÷ÿab"), (5, "repeated rows"), (5, "repeated rows"), (None, "without id, without id")]
    docs = spark.createDataFrame(rows, DOC).withColumns({"word": F.lit("x"), "n": F.lit(1), "id": F.lit("x")})
    got = _got(spelling.variants(docs))
    assert got.pop(long) == (2, 0, None, None, long)
    assert got == _variants([r for r in rows if r[0] != 4])
    assert spelling.variants(docs.limit(0)).count() == 0


def test_query_over_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = _got(registry.op12_spelling(spark, sf_dir))
    assert got == _variants(rows) and any(v[2] for v in got.values())


def test_runs_too_short_for_words_get_no_checksum(spark, monkeypatch):
    long = lambda word, *_: F.when(F.length(word) >= 7, word).otherwise(F.raise_error(F.lit("a short run")).cast("string"))
    monkeypatch.setattr(spelling, "misspelt", long)
    docs = spark.createDataFrame([(1, "a rather lengthy sentence"), (2, "the same lengthy one")], "doc_id long, text string")
    assert [(r.word, r.n) for r in spelling.variants(docs).collect()] == [("lengthy", 2)]
