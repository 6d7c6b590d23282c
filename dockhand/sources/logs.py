"""Log files: read as lines, sanitise, write back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.functions.masking import LOG_RULES
from dockhand.functions.paths import log_time, stem


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``; a large log is split over tasks."""
    return spark.read.text(path)


def sanitize_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Apply the log rules in their fixed order.

    Each rule reads the line before it more than once, so every step is a
    projection of its own and is computed once.
    """
    for _, rule in LOG_RULES:
        lines = lines.withColumn(line, rule(F.col(line)))
    return lines


def sanitized_name(path: Column, ts: Column) -> Column:
    """``<path without extension>_Sanitized_<time>.log``."""
    return F.concat(stem(path), F.lit("_Sanitized_"), log_time(ts), F.lit(".log"))


def write_sanitized(lines: DataFrame, folder: str, line: str = "value", order: str | None = None) -> None:
    """Write sanitised lines as text into ``folder``. Runs a job.

    With ``order`` (a line number) the part files hold the lines in that order.
    """
    clean = sanitize_lines(lines, line)
    if order:
        clean = clean.orderBy(order)
    clean.select(F.col(line).alias("value")).write.mode("overwrite").text(folder)
