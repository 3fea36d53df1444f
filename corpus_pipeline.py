"""Corpus pipeline: the stages that turn documents into packed training sequences.

Each stage works on all rows its predecessor kept. Language ID drops documents without a word or without a main language, the Jaccard join
keeps the smallest doc_id of each group of near duplicates, substring dedup cuts passages that start in a smaller
document, mixing repeats or leaves out documents to bring sources to their targets, packing turns the rest into sequences.
Rows with null text are rejected by the first stage. A stage starts when its predecessor's result is written, so it lets
Spark remove that one's shuffle files first. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import jaccard, langid, mixing, packing, substrings
from starloom.llm.tables import bounded_batches, release, stored, table


def _language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return langid.accepted(docs)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return jaccard.distinct_documents(docs)


def _substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    cut = substrings.deduplicate(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return mixing.mixed(docs)


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return packing.pack(docs)


STAGES = [
    ("language ID", _language),
    ("n-gram Jaccard join", _near_duplicates),
    ("substring dedup", _substrings),
    ("mixing", _mix),
    ("packing", _pack),
]

#: Learned models and tokenizers have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
