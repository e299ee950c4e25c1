"""From raw documents to token ids: quality, near duplicates, benchmark passages, personal data, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the columns of documents,
the last one the encoded texts. A stage's result is written as Parquet and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailrace.llm import bpe, decontaminate, near_dup, quality, surrogates
from tailrace.llm.queries import SURROGATE_KEY, trained_quality, vocabulary
from tailrace.llm.ranks import numbered
from tailrace.llm.tables import Tables, source

ORACLE_SQL = None  # a trained classifier, MinHash and keyed digests have no form in SQL


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score below 0.3."""
    model, _ = trained_quality(docs, sf_dir)
    return quality.scored(docs, model).where("predicted = 1").select(_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group, of the smallest doc_id. Ids that are null or repeated do not matter: rows are told apart by number."""
    rows = docs.select("doc_id", F.col("doc_id").isNull().alias("nameless"), F.struct(_columns(docs)).alias("row"))
    if rows.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty():
        rows = rows.withColumn("pos", F.col("doc_id"))
    else:
        rows = numbered(rows, [], ["nameless", "doc_id"], Tables(spark, "pipeline-rows"), "rows")
    gone = near_dup.near_duplicates(rows.select(F.col("pos").alias("doc_id"), F.col("row.text").alias("text"))).where("not kept")
    return rows.join(gone.select(F.col("doc_id").alias("pos")), "pos", "left_anti").select("row.*")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.clean(docs, source(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data; n_chars follows the new text."""
    new = surrogates.surrogated(docs, SURROGATE_KEY)
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_entities") > 0, F.length("text")).otherwise(F.col("n_chars"))
        new = new.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return new.select(_columns(docs))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and of the decoded text, and the ids."""
    return bpe.encode(docs, vocabulary())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("personal_data", replace_personal_data),
    ("bpe", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents."""
    tables = Tables(spark, "pipeline")
    docs = source(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = tables.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
