"""The pipeline's stages on documents with planted cases."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp


def test_planted_cases(spark, tmp_path):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["ba", "ter", "lo", "ni", "sel", "ka", "dor", "the"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() if i % 7 else "the" for i in range(n)).capitalize() + "."
    clean = ["\n".join(prose(60) for _ in range(4)) for _ in range(60)]
    passage, item = prose(70), prose(40)
    docs = list(clean)
    near = clean[0].split(" ")
    near[11], near[90] = "xxx", "yyy"
    docs += [clean[1], " ".join(near)]
    docs += [f"{prose(80)}\n{passage}\n{prose(50)}" for _ in range(5)]
    docs += [f"{prose(30)} {item} {prose(30)}"]
    docs += [" ".join(f"{word()}###" for _ in range(60)), prose(20) + " you idiot moron stupid loser scum " + prose(10)]
    n = len(docs)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(docs)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0), (n - 1, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    kept = {r.doc_id: r for r in cp.run(spark, folder).collect()}
    assert set(range(60)) <= set(kept)
    assert not {60, n - 3, n - 2, n - 1} & set(kept)
    assert all(r.round_trip and len(np.frombuffer(r.ids, "<u4")) == r.n_tokens for r in kept.values())
    source = spark.read.parquet(f"{folder}/documents.parquet")
    lines = cp.dedup_lines(spark, source, folder).where(F.contains("text", F.lit(passage))).count()
    assert lines == 1
    alone = {r.doc_id for r in cp.dedup_documents(spark, source, folder).collect()}
    assert set(range(60)) <= alone and not {60, 61} & alone


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert 4 <= len(cp.STAGES) <= 5 and cp.ORACLE_SQL is None
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_short_lines_go_too(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"Share\nthe {i * 7919} words of document number {i * 104729}\nRead more", "en", "s", 0) for i in range(4)], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r.text for r in cp.dedup_lines(spark, docs, str(tmp_path)).collect()}
    assert left[0].startswith("Share\n") and left[0].endswith("\nRead more")
    assert all("Share" not in left.get(i, "") and "Read more" not in left.get(i, "") for i in (1, 2, 3))


def test_columns_with_the_operators_names_stay(spark, sf_dir):
    """Values of other columns, also of rows without doc_id, are those of the input after every stage."""
    names = ["n_lines", "dropped", "kept_text", "_pipeline_key", "_pipeline_row", "id", "class_id", "copy_of", "keep", "n_words", "n_hit", "items", "word", "a.b", "v", "rank"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60 or doc_id % 10 = 0")
    own = F.concat_ws("-", F.lit("own"), F.coalesce(F.col("doc_id").cast("string"), F.md5("text")))
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("doc_id")))
    docs = docs.select("*", *[F.concat(own, F.lit(n)).alias(n) for n in names], F.lit("x").alias("n_items"))
    quoted = [f"`{n}`" for n in names]
    want = {tuple(r) for r in docs.select("doc_id", *quoted).collect()}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.schema["dropped"].dataType.typeName() == "string", name
        rows = out.select("doc_id", *quoted, "text", "n_chars").collect()
        assert rows and {tuple(r)[:-2] for r in rows} <= want, name
        assert any(r.doc_id is None for r in rows) and all(r.n_chars == len(r.text or "") for r in rows), name
    tokens = cp.tokenise(spark, docs, sf_dir)
    assert tokens.count() == docs.count() and tokens.where("not round_trip").isEmpty()
