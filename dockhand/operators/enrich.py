"""Content statistics, entities and keywords; all computed inside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.functions.text import all_stop_words, exploded_terms, tokens, with_term_counts, with_top_terms, word_count

KEYWORDS_PER_DOCUMENT = 10

# Entity rules: what a text must hold for them to be tried, then label and
# pattern; reported in this order. Most texts pass the cheap tests untouched.
# An address starts where its run of address characters starts, so a long run
# is scanned once.
ENTITY_RULES = [
    ("@", [("EMAIL", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")]),
    ("://", [("URL", r"https?://[^\s<>\"]+")]),
    (
        "[0-9]",
        [
            ("DATE", r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b"),
            ("MONEY", r"[$€£][0-9][0-9.,]*"),
            ("PART_NO", r"\bPN-[0-9]+\b"),
            ("CARDINAL", r"\b[0-9]+\b"),
        ],
    ),
]
ENTITIES = "array<struct<text: string, label: string>>"


def content_stats(df: DataFrame, content: str = "content") -> DataFrame:
    """Add ``content_length`` in characters and ``word_count``."""
    return df.withColumns(
        {
            "content_length": F.length(content).cast("long"),
            "word_count": F.coalesce(word_count(F.col(content)), F.lit(0)).cast("long"),
        }
    )


def entities(text: Column) -> Column:
    """Array of (text, label), rule by rule in text order; empty for NULL."""

    def found(label: str, pattern: str) -> Column:
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.transform(matches, lambda match: F.struct(match.alias("text"), F.lit(label).alias("label")))

    groups = [
        F.when(text.rlike(needs), F.concat(*[found(*rule) for rule in rules])).otherwise(F.array().cast(ENTITIES))
        for needs, rules in ENTITY_RULES
    ]
    return F.concat(*groups)


def extract_entities(df: DataFrame, text: str = "text", max_chars: int | None = None) -> DataFrame:
    """Add ``entities``; the whole text is read unless ``max_chars`` asks for a prefix."""
    source = F.col(text) if max_chars is None else F.substring(text, 1, max_chars)
    return df.withColumn("entities", entities(source))


def keywords_of(df: DataFrame, words: Column, k: int = KEYWORDS_PER_DOCUMENT) -> DataFrame:
    """Add ``keywords``: the ``k`` most frequent words that are not stop words.

    Ties go by the word. No shuffle: words are counted inside the row.
    """
    stop = all_stop_words()
    return with_top_terms(df, F.filter(words, lambda word: ~word.isin(stop)), "keywords", k)


def top_keywords(df: DataFrame, text: str = "text", k: int = KEYWORDS_PER_DOCUMENT) -> DataFrame:
    """:func:`keywords_of` the words of a text."""
    return keywords_of(df, tokens(F.col(text)), k)


def gazetteer_entities(
    df: DataFrame, gazetteer: DataFrame, key: str, text: str = "text"
) -> DataFrame:
    """Rows (key, name, label, n) for every gazetteer name found among the words.

    ``gazetteer`` has one row per ``name`` (one lower-case word) and ``label``.
    The words of a document are counted in the row, so the equi join sees each
    word of a document once; AQE splits a word that occurs everywhere.
    """
    counted = with_term_counts(df.select(key, text), tokens(F.col(text)), "__terms")
    found = exploded_terms(counted, "__terms", key)
    return found.join(gazetteer, found["term"] == gazetteer["name"]).select(key, "name", "label", "n")
