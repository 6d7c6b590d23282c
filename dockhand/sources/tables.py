"""Table scans and append sinks; the table format is a setting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREVIEW_ROWS = 20


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """All rows of a catalogue table."""
    return spark.table(name)


def preview(df: DataFrame, order: list[str], n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def append_table(df: DataFrame, table: str, table_format: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Append to a catalogue table by column name, creating it on first use. Runs a job."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df.select(*spark.table(table).columns).write.mode("append").insertInto(table)
        return
    writer = df.write.format(table_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def overwrite_table(df: DataFrame, table: str, table_format: str = "parquet") -> None:
    """Replace a stored aggregate. Runs a job."""
    df.write.format(table_format).mode("overwrite").saveAsTable(table)


def write_json_documents(df: DataFrame, folder: str, compression: str = "none", mode: str = "append") -> None:
    """One JSON object per document and line. Runs a job."""
    df.write.mode(mode).option("compression", compression).json(folder)


def write_package(manifests: DataFrame, folder: str, compression: str = "gzip") -> None:
    """Hand-over manifests, one JSON text per line, compressed. Runs a job."""
    manifests.select(F.col("manifest").alias("value")).write.mode("append").option("compression", compression).text(folder)


def append_manifest(lines: DataFrame, folder: str, line: str = "line") -> None:
    """Append manifest lines to a text folder. Runs a job."""
    lines.select(F.col(line).alias("value")).write.mode("append").text(folder)
