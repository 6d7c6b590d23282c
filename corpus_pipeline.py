"""The corpus pipeline: quality, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the
next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.llm import exact_dedup, mixing, near_dedup, packing, quality
from dockhand.llm.common import DOCUMENT, fold, table, written


SHINGLE_WORDS = 5  # of the stage of near copies; op3 has its own number


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of the labelled rows accepts."""
    labels = table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.filter(fold(F.col("doc_id")) != 0))
    scored = quality.with_scores(docs.select(*DOCUMENT), model)
    return scored.filter(F.col("score") >= quality.THRESHOLD).select(*DOCUMENT)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs).select(*DOCUMENT)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return near_dedup.drop_near_copies(docs, SHINGLE_WORDS).select(*DOCUMENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken more than once is there as often."""
    return mixing.mixed_documents(docs).select(*DOCUMENT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("good_quality", good_quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mix", mix),
    ("pack", pack),
]

# Model scores, seeded choices and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
