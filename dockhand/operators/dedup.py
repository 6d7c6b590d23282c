"""Duplicate files by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockhand.functions.crypto import md5_hex, sha256_hex
from dockhand.functions.paths import basename


def content_hashes(files: DataFrame, content: str = "content") -> DataFrame:
    """Add ``sha256`` and ``md5`` of the whole content."""
    return files.withColumns({"sha256": sha256_hex(F.col(content)), "md5": md5_hex(F.col(content))})


def new_registry_rows(files: DataFrame, registry: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Rows (filename, sha256, md5) to add to the registry.

    Of equal files the first by path is taken, and none whose hash is already
    registered. Only hash and path are shuffled, never the content; the
    first-of-group cut is taken per task first, so a content that makes up a
    large share of all files costs one row per task.
    """
    hashed = content_hashes(files.select(path, content), content).select(path, "sha256", "md5")
    first = Window.partitionBy("sha256").orderBy(path)
    unique = hashed.withColumn("__rn", F.row_number().over(first)).filter(F.col("__rn") == 1)
    fresh = unique.join(registry.select("sha256"), "sha256", "left_anti")
    return fresh.select(basename(F.col(path)).alias("filename"), "sha256", "md5")
