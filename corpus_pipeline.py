"""A training-corpus pipeline over `documents`: five stages, each the work of one corpus operator.

Every stage but the last returns the columns of documents, with n_chars set to the text that is left. Null and empty texts
go in the first stage; a later one keeps them, as they repeat nothing. Texts of any length are read whole. Rows of one
doc_id are one document, and share its fate; a row without doc_id is a document of its own, after all others. Of equal
documents or lines the first by id stays. Other columns of the input, whatever their names, stay as they are. An empty
table gives no rows in any stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from pluvio.llm._graph import Scratch, shared
from pluvio.llm.registry import vocabulary

#: SQL cannot express the classifier and the tokeniser; tests hold the stages against brute force.
ORACLE_SQL = None
#: The id that a stage's operator knows a row by, and the row's other columns.
_KEY, _ROW = "_pipeline_key", "_pipeline_row"


def _keyed(docs: DataFrame) -> DataFrame:
    """(_KEY, doc_id, text, _ROW): the doc_id, or for a null one a number of the row's own beyond all ids; the columns but
    text are packed, so that no name of theirs meets one of an operator's."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.monotonically_increasing_id())
    return docs.select(key.alias(_KEY), "doc_id", "text", F.struct(*[_named(c) for c in docs.columns if c != "text"]).alias(_ROW))


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _unpacked(keyed: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as they were before _keyed, with the text that is there now."""
    return keyed.select([F.col("text") if c == "text" else F.col(_ROW).getField(c).alias(c) for c in columns])


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Keyed docs without the rows of these ids."""
    return docs.join(dropped.select(F.col("id").alias(_KEY)).distinct(), _KEY, "left_anti")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label scorer rejects as low quality or toxic go; others stay as they are."""
    columns, docs = docs.columns, _keyed(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scorer = quality.fit(docs, labels)
    return _unpacked(_without(docs, quality.judge(docs, scorer, _KEY).where("not keep")), columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that repeat an earlier line up to two edits, or exactly if they are short; documents go that have lost all
    their words by that."""
    left = line_dedup.dedup_lines(_keyed(docs), _KEY, min_chars=line_dedup.LEAST_CHARS, exact_chars=1)
    left = left.where((F.size("dropped") == 0) | F.col("kept_text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    out = _unpacked(left.select(F.col("kept_text").alias("text"), _ROW), docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id stays."""
    columns, docs = docs.columns, _keyed(docs)
    return _unpacked(_without(docs, near_dedup.near_duplicates(docs, _KEY).where("id <> class_id")), columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words a twentieth or more stand in benchmark passages; others keep their text."""
    columns, docs = docs.columns, _keyed(docs)
    hits = decontaminate.benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), _KEY)
    return _unpacked(_without(docs, hits.where(decontaminate.contaminated())), columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids (little-endian unsigned 32-bit), their number, and whether decoding them gives the text."""
    decoded = bpe.encode(docs, vocabulary(), keep=("text",), decoded=True)
    same = F.coalesce(F.col("text"), F.lit("")) == F.col("decoded")
    return decoded.select(F.col("id").alias("doc_id"), "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", dedup_lines),
    ("MinHash near-dedup", dedup_documents),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again for the next, and go when all are done."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for i, (_name, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if i + 1 < len(STAGES):
                docs = scratch.stored(docs)
        return shared(docs)
