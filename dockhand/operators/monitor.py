"""Processing status, metrics, retries and alerts over the attempt log.

The log has one row per status change: ``FileID, Status, DurationSeconds,
ErrorLog, ts`` and a unique ``event_id`` that breaks ties in time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockhand.operators.manifests import latest_by_key
from dockhand.operators.numbering import split_row_number

# Status words of the log and of a file's outcome.
PROCESSING, COMPLETED, RETRIED, FAILED = "Processing", "Completed", "Retried", "Failed"
OUTCOMES = ("pending", "processing", "success", "failed", "retrying")
MAX_RETRIES = 3
RECENT_ERRORS = 10


@dataclass(frozen=True)
class RetryPolicy:
    """When a failed attempt is tried again.

    ``attempts`` in all; the delay after failure n is ``2**n`` seconds or
    ``fixed_delay``; ``wait_after_last`` tells whether the last failure is
    followed by a delay too.
    """

    name: str
    attempts: int
    fixed_delay: int | None = None
    wait_after_last: bool = False


# The four retry policies in use.
RETRY_POLICIES = [
    RetryPolicy("doubling_3", 3),
    RetryPolicy("doubling_3_trailing", 3, wait_after_last=True),
    RetryPolicy("doubling_4", 4),
    RetryPolicy("fixed_5", 5, fixed_delay=2, wait_after_last=True),
]


def is_success(status: Column) -> Column:
    return status == COMPLETED


def is_failure(status: Column) -> Column:
    """A failed attempt, whether it is tried again or not."""
    return status.isin(RETRIED, FAILED)


def current_status(log: DataFrame) -> DataFrame:
    """Newest row per file; NULLs of the newest row stay NULL."""
    return latest_by_key(log, ["FileID"], [F.desc("ts"), F.desc("event_id")])


def processing_metrics(monitor: DataFrame) -> DataFrame:
    """One row of totals over the status table; sums are NULL on an empty table."""
    def total(word):
        return F.sum(F.when(F.col("Status") == word, 1).otherwise(0))

    return monitor.agg(
        F.count(F.lit(1)).alias("TotalProcessed"),
        total(FAILED).alias("TotalFailed"),
        total(RETRIED).alias("TotalRetried"),
        F.avg(F.col("DurationSeconds").cast("decimal(18,6)")).cast("decimal(10,2)").alias("AvgProcessingTime"),
    )


def attempt_metrics(log: DataFrame) -> DataFrame:
    """Attempts that succeeded and failed, success rate, mean time, last success.

    Rates are 0, not NULL, where nothing was attempted.
    """
    status = F.col("Status")
    totals = log.agg(
        F.count_if(is_success(status)).alias("files_processed"),
        F.count_if(is_failure(status)).alias("files_failed"),
        F.coalesce(
            F.sum(F.when(is_success(status), F.col("DurationSeconds").cast("decimal(18,6)"))), F.lit(0)
        ).alias("total_time"),
        F.max(F.when(is_success(status), F.col("ts"))).alias("last_processed"),
    )
    done, tried = F.col("files_processed"), F.col("files_processed") + F.col("files_failed")
    return totals.select(
        "files_processed",
        "files_failed",
        F.when(tried > 0, F.round(done / tried, 6)).otherwise(0.0).alias("success_rate"),
        F.when(done > 0, F.round(F.col("total_time").cast("double") / done, 6))
        .otherwise(0.0)
        .alias("average_processing_time"),
        "last_processed",
    )


def error_message(path: Column, error: Column) -> Column:
    """Text kept for a failed attempt."""
    return F.concat(F.lit("Processing failed for "), path, F.lit(": "), error)


def recent_errors(log: DataFrame, n: int = RECENT_ERRORS) -> DataFrame:
    """The last ``n`` failed attempts; each task keeps ``n`` rows, the driver none."""
    failures = log.filter(is_failure(F.col("Status")))
    return failures.orderBy(F.desc("ts"), F.desc("event_id")).limit(n)


def recent_error_list(log: DataFrame, n: int = RECENT_ERRORS) -> DataFrame:
    """One row: the last ``n`` messages as an array in time order."""
    pairs = F.sort_array(F.collect_list(F.struct("ts", "event_id", "ErrorLog")))
    return recent_errors(log, n).agg(F.transform(pairs, lambda p: p["ErrorLog"]).alias("recent_errors"))


def file_outcome(log: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Per file: tries, last error, and where it ended.

    Counts, flags and the newest error combine on the map side.
    """
    status, failed = F.col("Status"), is_failure(F.col("Status"))
    grouped = log.groupBy("FileID").agg(
        F.count_if(is_success(status) | failed).alias("tries"),
        F.count_if(failed).alias("failures"),
        F.max_by(F.when(failed, F.col("ErrorLog")), F.when(failed, F.struct("ts", "event_id"))).alias("last_error"),
        F.coalesce(F.bool_or(is_success(status)), F.lit(False)).alias("succeeded"),
        F.coalesce(F.bool_or(status == PROCESSING), F.lit(False)).alias("started"),
    )
    outcome = (
        F.when(F.col("succeeded"), "success")
        .when(F.col("failures") >= max_retries, "failed")
        .when(F.col("failures") > 0, "retrying")
        .when(F.col("started"), "processing")
        .otherwise("pending")
    )
    return grouped.select("FileID", "tries", "failures", "last_error", outcome.alias("outcome"))


def numbered_failures(log: DataFrame) -> DataFrame:
    """Failed attempts with their number per file.

    Numbered hour by hour and shifted, so a file that fails all the time is
    not sorted in one task.
    """
    return split_row_number(
        log.filter(is_failure(F.col("Status"))),
        ["FileID"],
        F.unix_date(F.to_date("ts")) * 24 + F.hour("ts"),
        [F.col("ts"), F.col("event_id")],
        "attempt",
    )


def retry_schedule(log: DataFrame, policies: list[RetryPolicy] | None = None) -> DataFrame:
    """Per policy and failed attempt: delay and time of the next try.

    A failure at or past the last attempt is final and has no next try.
    """
    variants = F.array(
        *[
            F.struct(
                F.lit(p.name).alias("policy"),
                F.lit(p.attempts).cast("long").alias("attempts"),
                F.lit(p.fixed_delay).cast("long").alias("fixed_delay"),
                F.lit(p.wait_after_last).alias("wait_after_last"),
            )
            for p in (policies or RETRY_POLICIES)
        ]
    )
    rows = numbered_failures(log).select("event_id", "FileID", "ts", "attempt", F.inline(variants))
    attempt, attempts = F.col("attempt"), F.col("attempts")
    waits = (attempt < attempts) | ((attempt == attempts) & F.col("wait_after_last"))
    # past the last attempt there is no delay, so the exponent stays small
    delay = F.when(waits, F.coalesce(F.col("fixed_delay"), F.pow(F.lit(2), F.least(attempt, attempts)).cast("long")))
    return rows.select(
        "policy",
        "event_id",
        "FileID",
        "attempt",
        delay.alias("delay_seconds"),
        F.when(
            attempt < attempts, F.col("ts") + F.make_dt_interval(secs=delay.cast("decimal(18,6)"))
        ).alias("next_retry_at"),
        (attempt >= attempts).alias("is_final"),
    )


def alert_message(path: Column, retries: int, error: Column) -> Column:
    """Text of a failure alert."""
    return F.concat(
        F.lit("🚨 File Processing Failed 🚨\nFile: "), path, F.lit(f"\nRetries: {retries}\nError: "), error
    )


def failure_alerts(log: DataFrame, path: Column, max_retries: int = MAX_RETRIES) -> DataFrame:
    """One alert row per file that used up its retries. Nothing is sent."""
    lost = file_outcome(log, max_retries).filter(F.col("outcome") == "failed")
    return lost.select(
        "FileID",
        F.col("failures").alias("retries"),
        F.col("last_error").alias("error"),
        alert_message(path, max_retries, F.coalesce("last_error", F.lit(""))).alias("message"),
    )


def processing_log(numbered: DataFrame, path: Column) -> DataFrame:
    """Log rows (FileID, LogMessage, LogLevel) of every status change.

    ``numbered`` is the log with ``attempt`` filled for failed attempts.
    """
    status = F.col("Status")

    def entry(level, *parts):
        return F.struct(F.concat(*parts).alias("LogMessage"), F.lit(level).alias("LogLevel"))

    started = entry("INFO", F.lit("Processing file: "), path)
    finished = entry(
        "INFO", F.lit("File processed successfully in "), F.col("DurationSeconds").cast("string"), F.lit(" seconds.")
    )
    broken = entry("ERROR", F.lit("Error processing file: "), F.coalesce("ErrorLog", F.lit("")))
    again = entry(
        "WARNING", F.lit("Retry attempt "), F.col("attempt").cast("string"), F.lit(" for file: "), path
    )
    given_up = entry("ERROR", F.lit("File processing failed after max retries."))
    rows = (
        F.when(status == PROCESSING, F.array(started))
        .when(status == COMPLETED, F.array(finished))
        .when(status == RETRIED, F.array(broken, again))
        .when(status == FAILED, F.array(broken, given_up))
    )
    return numbered.select("FileID", F.inline(rows))


def metric_samples(log: DataFrame, every: str = "30 seconds") -> DataFrame:
    """Per interval with any finished attempt: totals so far, and the previous sample.

    Rows ``sample_ts, n_processed, n_failed, files_processed, files_failed,
    previous_ts``. Running totals are taken within a day and shifted by the
    totals of earlier days: one task orders one row per day, never the samples.
    """
    status = F.col("Status")
    finished = log.filter(is_success(status) | is_failure(status))
    samples = (
        finished.groupBy(F.window("ts", every).alias("w"))
        .agg(
            F.count_if(is_success(status)).alias("n_processed"),
            F.count_if(is_failure(status)).alias("n_failed"),
        )
        .select(F.col("w.end").alias("sample_ts"), "n_processed", "n_failed")
        .withColumn("__day", F.to_date("sample_ts"))
    )
    earlier = Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        samples.groupBy("__day")
        .agg(
            F.sum("n_processed").alias("day_processed"),
            F.sum("n_failed").alias("day_failed"),
            F.max("sample_ts").alias("day_last"),
        )
        .select(
            "__day",
            F.coalesce(F.sum("day_processed").over(earlier), F.lit(0)).alias("__processed"),
            F.coalesce(F.sum("day_failed").over(earlier), F.lit(0)).alias("__failed"),
            F.max("day_last").over(earlier).alias("__last"),
        )
    )
    in_day = Window.partitionBy("__day").orderBy("sample_ts")
    so_far = in_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = samples.withColumns(
        {
            "__run_processed": F.sum("n_processed").over(so_far),
            "__run_failed": F.sum("n_failed").over(so_far),
            "__previous": F.lag("sample_ts").over(in_day),
        }
    )
    return running.join(days, "__day").select(
        "sample_ts",
        "n_processed",
        "n_failed",
        (F.col("__processed") + F.col("__run_processed")).alias("files_processed"),
        (F.col("__failed") + F.col("__run_failed")).alias("files_failed"),
        F.coalesce("__previous", "__last").alias("previous_ts"),
    )


def interval_rates(samples: DataFrame) -> DataFrame:
    """Files per second between consecutive samples; the first has no rate."""
    seconds = (F.col("sample_ts") - F.col("previous_ts")).cast("interval second").cast("long")
    return samples.withColumn("seconds", seconds).filter(F.col("seconds") > 0).select(
        "sample_ts", "seconds", (F.col("n_processed") / F.col("seconds")).alias("rate")
    )


def throughput(samples: DataFrame) -> DataFrame:
    """Mean of the interval rates (not total over total)."""
    return interval_rates(samples).agg(
        F.count(F.lit(1)).alias("n_intervals"), F.round(F.avg("rate"), 9).alias("average_throughput")
    )


def batch_acceptance(results: DataFrame, batch: str, success: str, threshold: float = 0.8) -> DataFrame:
    """Per batch: files, successes, and whether the success rate reaches the threshold."""
    return (
        results.groupBy(batch)
        .agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.col(success)).alias("n_success"))
        .withColumn("accepted", F.col("n_success") / F.col("n_files") >= threshold)
    )
