"""From a table of documents to packed training sequences, in five stages.

Each stage works on all documents that the one before it kept, and but for the last returns documents with the same
columns. Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.catalog.registry import query
from foldmark.llm import decontamination, packing, pii, simhash, toxicity
from foldmark.llm.common import quoted, table
from foldmark.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: similarity of 0.8 or more over shingles of five words."""
    return simhash.near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in angle brackets."""
    masked = pii.mask_personal_data(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*map(quoted, docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: Fitted models, fingerprints and a tokenizer: SQL can't say it. tests/llm/test_pipeline.py holds the stages to brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
