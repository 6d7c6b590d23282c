from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dockhand.operators import monitor
from dockhand.operators.numbering import split_row_number, surrogate_keys

LOG = "event_id bigint, FileID bigint, ts timestamp_ntz, Status string, DurationSeconds double, ErrorLog string"
START = datetime(2024, 1, 1)


def log(spark, rows):
    """Rows (file, seconds, status, duration, error)."""
    return spark.createDataFrame(
        [(i, f, START + timedelta(seconds=s), status, d, e) for i, (f, s, status, d, e) in enumerate(rows)], LOG
    )


def test_metrics_of_nothing(spark):
    assert list(monitor.processing_metrics(log(spark, [])).first()) == [0, None, None, None]
    assert list(monitor.attempt_metrics(log(spark, [])).first()) == [0, 0, 0.0, 0.0, None]
    assert monitor.throughput(monitor.metric_samples(log(spark, []))).first().n_intervals == 0


def test_metrics(spark):
    rows = [(1, 0, "Failed", None, "x"), (2, 1, "Completed", 1.0, None), (3, 2, "Completed", 2.005, None), (4, 3, "Retried", None, "y")]
    row = monitor.processing_metrics(log(spark, rows)).first()
    assert list(row) == [4, 1, 1, Decimal("1.50")]
    row = monitor.attempt_metrics(log(spark, rows)).first()
    assert list(row) == [2, 2, 0.5, 1.5025, START + timedelta(seconds=2)]


def test_current_status_keeps_nulls_and_breaks_ties(spark):
    rows = [(1, 0, "Failed", None, "x"), (1, 5, "Completed", 3.0, None), (2, 0, "Retried", None, "a"), (2, 0, "Failed", None, "b")]
    got = {r.FileID: (r.Status, r.ErrorLog) for r in monitor.current_status(log(spark, rows)).collect()}
    assert got == {1: ("Completed", None), 2: ("Failed", "b")}


@pytest.mark.parametrize("n", [3, 10, 11])
def test_recent_errors(spark, n):
    rows = [(1, i, "Failed", None, f"e{i}") for i in range(n)] + [(1, 99, "Completed", 1.0, None)]
    got = monitor.recent_error_list(log(spark, rows)).first().recent_errors
    assert got == [f"e{i}" for i in range(n)][-10:]


def test_outcomes_and_alerts(spark):
    rows = [(1, 0, "Processing", None, None)]
    rows += [(2, i, "Failed", None, f"e{i}") for i in range(3)]
    rows += [(3, 0, "Failed", None, "e"), (3, 1, "Completed", 1.0, None)]
    rows += [(4, 0, "Retried", None, "once")]
    df = log(spark, rows)
    got = {r.FileID: (r.tries, r.last_error, r.outcome) for r in monitor.file_outcome(df).collect()}
    assert got == {1: (0, None, "processing"), 2: (3, "e2", "failed"), 3: (2, "e", "success"), 4: (1, "once", "retrying")}
    (alert,) = monitor.failure_alerts(df, F.lit("/p")).collect()
    assert alert.FileID == 2 and alert.message.endswith("File: /p\nRetries: 3\nError: e2")


def test_retry_delays_of_every_policy(spark):
    rows = [(7, 10 * i, "Failed", None, "e") for i in range(6)]
    got = {}
    for r in monitor.retry_schedule(log(spark, rows)).orderBy("attempt").collect():
        got.setdefault(r.policy, []).append((r.delay_seconds, r.next_retry_at is not None))
    assert [d for d, _ in got["doubling_3"]] == [2, 4, None, None, None, None]
    assert [d for d, _ in got["doubling_3_trailing"]] == [2, 4, 8, None, None, None]
    assert [d for d, _ in got["doubling_4"]] == [2, 4, 8, None, None, None]
    assert [d for d, _ in got["fixed_5"]] == [2, 2, 2, 2, 2, None]
    assert [again for _, again in got["doubling_3"]] == [True, True, False, False, False, False]


def test_samples_across_days(spark):
    rows = [(1, s, "Completed", 1.0, None) for s in (0, 10, 40, 86_400, 86_500, 3 * 86_400 + 5)] + [(1, 41, "Failed", None, "x")]
    got = monitor.metric_samples(log(spark, rows)).orderBy("sample_ts").collect()
    assert [r.files_processed for r in got] == [2, 3, 4, 5, 6]
    assert [r.files_failed for r in got] == [0, 1, 1, 1, 1]
    assert [r.previous_ts for r in got] == [None] + [r.sample_ts for r in got[:-1]]
    rates = [r.rate for r in monitor.interval_rates(monitor.metric_samples(log(spark, rows))).orderBy("sample_ts").collect()]
    seconds = [(b.sample_ts - a.sample_ts).total_seconds() for a, b in zip(got, got[1:], strict=False)]
    assert rates == pytest.approx([1 / s for s in seconds])


def test_acceptance_threshold(spark):
    df = spark.createDataFrame([("a", i < 8) for i in range(10)] + [("b", i < 7) for i in range(10)], "batch string, ok boolean")
    assert {r.batch: r.accepted for r in monitor.batch_acceptance(df, "batch", "ok").collect()} == {"a": True, "b": False}


def test_row_numbers_of_a_hot_key(spark):
    """One key with a third of all rows is numbered like the others."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("k"), ((F.col("id") * 7919) % 30_011).alias("o"), "id"
    )
    got = split_row_number(df, ["k"], F.floor(F.col("o") / 500), [F.col("o"), F.col("id")]).toPandas()
    want = got.sort_values(["k", "o", "id"]).groupby("k").cumcount() + 1
    assert (want.sort_index() == got["row_num"]).all()


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = spark.range(20_000).select(((F.col("id") * 7919) % 20_011).alias("v")).repartition(7)
    got = surrogate_keys(df, [F.col("v")], "key").orderBy("v").toPandas()
    assert list(got["key"]) == list(range(1, 20_001))
