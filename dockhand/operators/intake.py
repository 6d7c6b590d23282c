"""Validation, routing, retention and extraction of landed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.functions.markup import html_metadata, html_text
from dockhand.functions.paths import basename, has_accepted_extension, is_hidden
from dockhand.functions.text import strip


def validation_reason(content: Column, size: Column) -> Column:
    """First rule a file breaks, or NULL when it is valid.

    Existence and readability are the scan's business: a path that cannot be
    read never becomes a row.
    """
    return (
        F.when(size.isNull(), "missing")
        .when(size == 0, "empty")
        .when(content.isNull(), "no_content")
        .when(strip(content) == "", "blank")
    )


def validate_files(files: DataFrame, content: str = "content", size: str = "size") -> DataFrame:
    """Add ``reason`` (NULL for a valid file)."""
    return files.withColumn("reason", validation_reason(F.col(content), F.col(size)))


def drop_hidden(files: DataFrame, path: str = "path") -> DataFrame:
    """Keep files whose name does not start with a dot."""
    return files.filter(~is_hidden(basename(F.col(path))))


def accept_extensions(files: DataFrame, path: str = "path") -> DataFrame:
    """Keep files with an accepted extension."""
    return files.filter(has_accepted_extension(F.col(path)))


def expired(files: DataFrame, as_of: Column, days: int = 30, modified: str = "modified") -> DataFrame:
    """Files strictly older than ``days`` at ``as_of``: the delete list."""
    return files.filter(F.col(modified) < as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def retained(files: DataFrame, as_of: Column, days: int = 30, modified: str = "modified") -> DataFrame:
    """Files that retention keeps; a file exactly ``days`` old stays."""
    return files.filter(F.col(modified) >= as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def extract_with_fallback(
    files: DataFrame, primary: str, fallback: str, labels: tuple[str, str] = ("tika", "tesseract")
) -> DataFrame:
    """Add ``content`` and ``extraction_method``.

    The fallback is used when the first extractor gave no result (NULL), not
    when it gave an empty text.
    """
    return files.withColumns(
        {
            "content": F.coalesce(F.col(primary), F.col(fallback)),
            "extraction_method": F.when(F.col(primary).isNotNull(), labels[0]).otherwise(labels[1]),
        }
    )


def extract_html(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``content``, ``metadata`` (title, lang) and ``extraction_method``."""
    return pages.withColumns(
        {
            "content": html_text(F.col(html)),
            "metadata": html_metadata(F.col(html)),
            "extraction_method": F.lit("html"),
        }
    )


def route(files: DataFrame, reason: str = "reason") -> DataFrame:
    """Add ``route``: ``failed`` for a file with a reason, else ``archive``."""
    return files.withColumn("route", F.when(F.col(reason).isNotNull(), "failed").otherwise("archive"))


def split_routes(files: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(valid, failed) halves for two sinks."""
    return files.filter(F.col(reason).isNull()), files.filter(F.col(reason).isNotNull())
