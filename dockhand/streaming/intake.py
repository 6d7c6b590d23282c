"""Landing folder to processed documents, failed area, registry and archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockhand.functions.crypto import md5_hex, sha256_hex
from dockhand.functions.markup import html_text
from dockhand.functions.paths import basename, extension
from dockhand.operators.intake import split_routes, validation_reason
from dockhand.operators.language import Profile
from dockhand.plans.documents import process_documents
from dockhand.sources.landing import empty_files, stream_landing


BROADCAST_HASHES = 500_000  # hashes of a micro-batch that may be broadcast, about 60 MB


def landed_documents(files: DataFrame) -> DataFrame:
    """Landed bytes as input of the document flow; HTML files give their visible text."""
    text = F.col("content").cast("string")
    is_html = F.lower(extension(basename(F.col("path")))).isin(".html", ".htm")
    return files.select(
        F.xxhash64("path").alias("file_id"),
        "path",
        F.col("length").alias("size"),
        F.create_map(F.lit("resourceName"), basename(F.col("path"))).alias("metadata"),
        F.when(is_html, html_text(text)).otherwise(text).alias("extracted"),
        F.lit(None).cast("string").alias("ocr"),
    )


def _write_once(batch: DataFrame, folder: str, batch_id: int) -> None:
    """Write a micro-batch to a folder of its own, so a replayed batch replaces itself."""
    batch.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch_id={batch_id}")


def start_document_intake(
    spark: SparkSession,
    landing_dir: str,
    processed_dir: str,
    failed_dir: str,
    checkpoint_dir: str,
    profile: Profile,
    archive_dir: str | None = None,
    max_files_per_trigger: int | None = None,
    processed_at: Column | None = None,
) -> StreamingQuery:
    """Process each new file once and stop when none is left.

    Valid documents and failed files go to two folders, one subfolder per
    micro-batch. The checkpoint keeps what was read; a batch that is run again
    after a failure overwrites its own subfolders, so nothing is doubled.
    """
    files = landed_documents(stream_landing(spark, landing_dir, max_files_per_trigger, archive_dir))
    stamp = F.current_timestamp().cast("timestamp_ntz") if processed_at is None else processed_at
    documents = process_documents(files, profile, stamp)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        valid, failed = split_routes(batch)
        _write_once(valid.drop("reason", "route"), processed_dir, batch_id)
        _write_once(failed.select("file_id", "path", "reason"), failed_dir, batch_id)
        batch.unpersist()

    return (
        documents.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def record_empty_files(spark: SparkSession, landing_dir: str, failed_dir: str) -> None:
    """Add the empty files now in the landing folder to the failed area. Runs a job.

    A file stream never sees a file without a byte, so this goes with every
    run of the intake. The list replaces the one of the run before.
    """
    files = landed_documents(empty_files(spark, [landing_dir]))
    reason = validation_reason(F.col("extracted"), F.col("size"))
    _write_once(files.select("file_id", "path", reason.alias("reason")), failed_dir, -1)


def distinct_content(files: DataFrame) -> DataFrame:
    """First file of every content, kept in state.

    The state grows with the number of contents; where that is unbounded use
    :func:`start_registry_intake`, which keeps it in a table.
    """
    return files.withColumn("sha256", sha256_hex(F.col("content"))).dropDuplicates(["sha256"])


def start_registry_intake(
    spark: SparkSession, landing_dir: str, registry_dir: str, checkpoint_dir: str, max_files_per_trigger: int | None = None
) -> StreamingQuery:
    """Register contents not seen before: (filename, sha256, md5), one subfolder per micro-batch.

    A batch is compared with the subfolders of earlier batches only, so running
    it again gives the same rows. A batch of bounded size is broadcast, and the
    registry is filtered where it lies; else both sides are joined by hash.
    """
    hashed = stream_landing(spark, landing_dir, max_files_per_trigger).select(
        "path", sha256_hex(F.col("content")).alias("sha256"), md5_hex(F.col("content")).alias("md5")
    )
    schema = "filename STRING, sha256 STRING, md5 STRING, batch_id BIGINT"

    def register(batch: DataFrame, batch_id: int) -> None:
        known = (
            batch.sparkSession.read.schema(schema)
            .option("basePath", registry_dir)
            .parquet(registry_dir)
            .filter(F.col("batch_id") < batch_id)
        )
        first = Window.partitionBy("sha256").orderBy("path")
        unique = batch.withColumn("__rn", F.row_number().over(first)).filter(F.col("__rn") == 1)
        hashes = unique.select("sha256")
        if max_files_per_trigger and max_files_per_trigger <= BROADCAST_HASHES:
            hashes = F.broadcast(hashes)  # at most max_files_per_trigger rows
        seen = known.join(hashes, "sha256", "left_semi").select("sha256").distinct()
        fresh = unique.join(seen, "sha256", "left_anti")
        _write_once(fresh.select(basename(F.col("path")).alias("filename"), "sha256", "md5"), registry_dir, batch_id)

    # an empty first subfolder makes the registry readable from the start
    spark.createDataFrame([], "filename STRING, sha256 STRING, md5 STRING").write.mode("ignore").parquet(
        f"{registry_dir.rstrip('/')}/batch_id=-1"
    )
    return (
        hashed.writeStream.foreachBatch(register)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
