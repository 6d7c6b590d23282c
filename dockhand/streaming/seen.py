"""Contents that came before, with state and reads that do not grow with the past.

Two forms. :func:`distinct_within` keeps the hashes of a stated horizon in the
state of the stream and forgets older ones. :func:`start_bucketed_registry`
keeps every hash in a table whose folders are buckets of the hash: a batch
reads the buckets of its own hashes only, and of earlier batches only, so a
batch that comes again gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockhand.functions.crypto import md5_hex, sha256_hex
from dockhand.functions.paths import basename
from dockhand.sources.landing import stream_landing

BUCKET_DIGITS = 3  # hex digits of the hash: 4096 buckets
REGISTRY = "filename STRING, sha256 STRING, md5 STRING, bucket STRING, batch_id BIGINT"


def distinct_within(files: DataFrame, horizon: str, event_time: str = "modificationTime", content: str = "content") -> DataFrame:
    """One file of every content that recurs within ``horizon`` of event time ("30 days").

    A file that comes later than the horizon after the newest event time seen
    is dropped. A hash leaves the state, and its content counts as new again,
    once the watermark (the newest event time less the horizon) has passed its
    first sight by the horizon. So repetitions within one horizon are never
    let through, and the state holds the contents of two horizons.
    """
    hashed = files.withColumn("sha256", sha256_hex(F.col(content)))
    return hashed.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(["sha256"])


def bucket_of(sha256: Column) -> Column:
    return F.substring(sha256, 1, BUCKET_DIGITS)


def read_registry(spark: SparkSession, folder: str, buckets: list[str] | None = None, before: int | None = None) -> DataFrame:
    """Registered contents, of some buckets and of batches before a number; both are folders, so others are not opened."""
    rows = spark.read.schema(REGISTRY).option("basePath", folder).parquet(folder)
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(buckets))
    return rows if before is None else rows.filter(F.col("batch_id") < before)


def register(batch: DataFrame, batch_id: int, folder: str) -> None:
    """Add the contents (filename, sha256, md5) that no earlier batch has, each once, by smallest name. Runs jobs.

    Equal hashes are made one in every task before the shuffle. The driver
    reads the names of the batch's buckets, 4096 at most.
    """
    spark = batch.sparkSession
    unique = batch.groupBy("sha256").agg(F.min(F.struct("filename", "md5")).alias("row")).select(
        "row.filename", "sha256", "row.md5", bucket_of(F.col("sha256")).alias("bucket")
    )
    buckets = sorted(r["bucket"] for r in batch.select(bucket_of(F.col("sha256")).alias("bucket")).distinct().collect())
    known = read_registry(spark, folder, buckets, before=batch_id).select("sha256")
    fresh = unique.join(known, "sha256", "left_anti").withColumn("batch_id", F.lit(batch_id).cast("long"))
    fresh.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_id").parquet(folder)


def prepare_registry(spark: SparkSession, folder: str) -> None:
    """An empty registry where there is none."""
    empty = spark.createDataFrame([(None, "", None, "none", -1)], REGISTRY)
    empty.write.mode("ignore").partitionBy("bucket", "batch_id").parquet(folder)


def compact_registry(spark: SparkSession, source: str, target: str, before: int) -> None:
    """The rows of batches before a number as one file a bucket, in a new folder. Runs a job.

    The rows keep the number ``before - 1``, so batches from ``before`` on see them all.
    """
    rows = read_registry(spark, source, before=before).filter("bucket <> 'none'").withColumn("batch_id", F.lit(before - 1).cast("long"))
    prepare_registry(spark, target)
    rows.repartition("bucket").write.mode("append").partitionBy("bucket", "batch_id").parquet(target)


def start_bucketed_registry(
    spark: SparkSession, landing_dir: str, registry_dir: str, checkpoint_dir: str, max_files_per_trigger: int | None = None
) -> StreamingQuery:
    """Register the contents of a landing folder that were not seen before."""
    prepare_registry(spark, registry_dir)
    hashed = stream_landing(spark, landing_dir, max_files_per_trigger).select(
        basename(F.col("path")).alias("filename"), sha256_hex(F.col("content")).alias("sha256"), md5_hex(F.col("content")).alias("md5")
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        register(batch, batch_id, registry_dir)
        batch.unpersist()

    return (
        hashed.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
