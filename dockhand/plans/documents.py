"""The full document flow: validate, extract, mask, enrich, record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.functions.crypto import sha256_hex
from dockhand.functions.text import tokens
from dockhand.functions.masking import mask_document_a, mask_document_b
from dockhand.operators.enrich import content_stats, extract_entities, keywords_of
from dockhand.operators.intake import extract_with_fallback, route, validation_reason
from dockhand.operators.language import Profile, best_language, is_long_enough

MASKS = {"a": mask_document_a, "b": mask_document_b}


def process_documents(
    files: DataFrame,
    profile: Profile,
    processed_at: Column,
    primary: str = "extracted",
    fallback: str = "ocr",
    mask: str = "a",
) -> DataFrame:
    """Process landed files in one pass over the rows, without a shuffle.

    ``files`` has ``file_id, path, size, metadata`` and the texts of the two
    extractors. Failed files keep their row with ``reason`` and ``route`` set
    and no content. The hash is taken from the extracted, unmasked text.
    """
    extracted = extract_with_fallback(files, primary, fallback).drop(primary, fallback)
    checked = route(extracted.withColumn("reason", validation_reason(F.col("content"), F.col("size"))))
    valid = F.col("reason").isNull()
    masked = checked.withColumns(
        {
            "sha256": F.when(valid, sha256_hex(F.col("content"))),
            "content": F.when(valid, MASKS[mask](F.col("content"))),
        }
    )
    # the words are found once, for the keywords and for the language
    worded = extract_entities(content_stats(masked), "content").withColumn("__words", tokens(F.col("content")))
    keyed = keywords_of(worded, F.col("__words"))
    gated = F.when(is_long_enough(F.col("content")), F.col("__words"))
    return (
        keyed.withColumn("__words", gated)
        .withColumn("language", best_language("__words", profile))
        .withColumn("processed_at", processed_at)
        .select(
            "file_id",
            "path",
            "content",
            "metadata",
            "extraction_method",
            "content_length",
            "word_count",
            "language",
            "entities",
            "keywords",
            "sha256",
            "processed_at",
            "reason",
            "route",
        )
    )
