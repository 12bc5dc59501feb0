"""Queries of the corpus operators, with the SQL that gives the same rows where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, hard_negatives, html_text, itq, knn, labelled_pages, licenses, line_dedup, near_dedup, quality, secrets, spelling, sql, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(_table(spark, sf_dir, "documents"))
    kinds = F.array(*map(F.lit, secrets.KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["rank"]), x["start"], x["end"])), ",")
    of_kind = lambda k: (lambda x: x["rank"] == k)
    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(secrets.KINDS[:3])]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def vocabulary() -> str:
    """Path of the public byte-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = html_text.train(labelled_pages.labelled_pages())
    return html_text.main_text(_table(spark, sf_dir, "pages"), model).withColumn("n_chars", F.length("text").cast("long"))


#: Rules of the URL query: (host, path, verdict).
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES).select(
        F.col("id").alias("page_id"), "host", "path", "rule", "verdict"
    )


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return knn.top_k(vectors, vectors.where("vec_id % 50 = 0")).withColumnRenamed("id", "vec_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), vocabulary())
    return bpe.decode(encoded, vocabulary()).select(
        F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, _table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str, **lengths) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), **lengths).select("doc_id", "n_lines", F.array_join("dropped", ",").alias("dropped_lines"), "kept_text")


def op10_line_dedup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10 with short lines as the pipeline treats them."""
    return op10_line_dedup(spark, sf_dir, min_chars=line_dedup.LEAST_CHARS, exact_chars=1)


def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_vectors(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (
    op1_near_dedup,
    op2_decontaminate,
    op3_licenses,
    op4_secrets,
    op5_html_text,
    op6_url_filter,
    op7_top_k,
    op8_bpe,
    op9_quality,
    op10_line_dedup,
    op10_line_dedup_all,
    op11_vector_dedup,
    op12_spelling,
    op13_hard_negatives,
    pipeline,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_dedup": sql.NEAR_DEDUP,
        "op2_decontaminate": sql.DECONTAMINATE,
        "op3_licenses": sql.licenses(),
        "op6_url_filter": sql.url_filter(URL_RULES),
        "op7_top_k": sql.TOP_K,
        "op10_line_dedup": sql.LINE_DEDUP,
        "op10_line_dedup_all": sql.LINE_DEDUP_ALL,
        "op11_vector_dedup": sql.VECTOR_DEDUP,
        "op13_hard_negatives": sql.HARD_NEGATIVES,
    }
