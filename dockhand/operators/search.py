"""Inverted index, term statistics, ranked search and facets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.functions.text import exploded_terms, tokens, with_term_counts


def _lower_distinct(terms: list[str]) -> list[str]:
    return sorted({term.lower() for term in terms})


def postings(docs: DataFrame, key: str = "doc_id", text: str = "text", terms: list[str] | None = None) -> DataFrame:
    """Index rows (term, key, tf). No shuffle: a document is counted in its row.

    With ``terms`` only these words are counted, for a search without a
    stored index.
    """
    words = tokens(F.col(text))
    if terms is not None:
        words = F.filter(words, lambda word: word.isin(_lower_distinct(terms)))
    counted = with_term_counts(docs.select(key, text), words, "__terms")
    return exploded_terms(counted, "__terms", key).select("term", key, F.col("n").alias("tf"))


def term_stats(index: DataFrame) -> DataFrame:
    """Per term: documents that hold it (df) and total occurrences (cf).

    Combined on the map side, so a word found everywhere costs one row per task.
    """
    return index.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def write_index(index: DataFrame, path: str, key: str = "doc_id", mode: str = "overwrite") -> None:
    """Store the index sorted by (term, key) for pruned lookups. Runs a job.

    Ranges run over both columns, so a very common term spans many files.
    """
    index.repartitionByRange("term", key).sortWithinPartitions("term", key).write.mode(mode).parquet(path)


def matching(index: DataFrame, terms: list[str]) -> DataFrame:
    """Index rows of the query terms; on a stored index the filter is pushed to the scan."""
    return index.filter(F.col("term").isin(_lower_distinct(terms)))


def search(index: DataFrame, n_docs: DataFrame, terms: list[str], k: int, key: str = "doc_id") -> DataFrame:
    """The ``k`` best documents by the sum of tf * ln(N / df); ties by key.

    ``n_docs`` is a frame of one row and one column, read as a scalar
    subquery. Term statistics are taken over the query terms only, so there
    is one row per query term.
    """
    hits = matching(index, terms)
    weights = term_stats(hits).select("term", F.log(n_docs.scalar() / F.col("df")).alias("idf"))
    scored = (
        hits.join(F.broadcast(weights), "term")  # one row per query term
        .groupBy(key)
        .agg(F.round(F.sum(F.col("tf") * F.col("idf")), 6).alias("score"))
    )
    return scored.orderBy(F.desc("score"), key).limit(k)


def facet_counts(index: DataFrame, docs: DataFrame, terms: list[str], facets: list[str], key: str = "doc_id") -> DataFrame:
    """Documents holding any query term, counted by the facet columns."""
    hits = matching(index, terms).select(key).distinct()
    return docs.join(hits, key, "left_semi").groupBy(*facets).agg(F.count(F.lit(1)).alias("n_docs"))
