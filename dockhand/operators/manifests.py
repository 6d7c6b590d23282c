"""Manifest lines, latest status, JSON documents and hand-over packages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockhand.functions.crypto import sha256_hex
from dockhand.functions.paths import basename, compact_time, extension, iso_time, stem
from dockhand.functions.values import map_value


def manifest_line(ts: Column, status: Column, path: Column) -> Column:
    """``iso time | status | file name``."""
    return F.concat_ws(" | ", iso_time(ts), status, basename(path))


def latest_by_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """The newest row per key, whole.

    The cut to one row per key is taken in every task before the shuffle, so
    a key with a very long history sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def json_document_name(metadata: Column, ts: Column) -> Column:
    """File name of a stored JSON document."""
    return F.concat(map_value(metadata, "resourceName", "doc"), F.lit("_"), compact_time(ts), F.lit(".json"))


def handover_manifest(
    files: DataFrame,
    ts: Column,
    target_dir: str,
    plm_trace_id: str = "unknown",
    alm_trace_id: str = "unknown",
    processed_by: str = "data_pipeline",
    path: str = "path",
    content: str = "content",
) -> DataFrame:
    """Rows (path, target file, meta file, sha256, manifest JSON of nine fields).

    The unique id is taken from path and time instead of chance, so a repeated
    task writes the same names.
    """
    name = basename(F.col(path))
    stamp = compact_time(ts)
    uid = F.substring(F.sha2(F.concat(F.col(path), stamp), 256), 1, 8)
    base = F.concat_ws("_", stem(name), stamp, uid)
    named = files.withColumns(
        {
            "original_file": name,
            "embarkation_file": F.concat(base, extension(name)),
            "meta_file": F.concat(base, F.lit(".meta.json")),
            "sha256": sha256_hex(F.col(content)),
        }
    )
    manifest = F.to_json(
        F.struct(
            "original_file",
            "embarkation_file",
            "sha256",
            stamp.alias("timestamp"),
            F.col(path).alias("source_path"),
            F.concat(F.lit(target_dir.rstrip("/") + "/"), F.col("embarkation_file")).alias("destination_path"),
            F.lit(plm_trace_id).alias("plm_trace_id"),
            F.lit(alm_trace_id).alias("alm_trace_id"),
            F.lit(processed_by).alias("processed_by"),
        ),
        {"ignoreNullFields": "false"},
    )
    return named.select(path, "embarkation_file", "meta_file", "sha256", manifest.alias("manifest"))
