"""Seen contents: bounded state, pruned registry reads, stream equals batch."""

from __future__ import annotations

import datetime
import hashlib
import random

from dockhand.streaming import seen

DAY = datetime.timedelta(days=1)
START = datetime.datetime(2024, 1, 1)


def digest(content):
    return hashlib.sha256(content.encode()).hexdigest()


def test_state_is_bounded_over_fifty_batches(spark, tmp_path):
    r = random.Random(2)
    schema = "name string, modificationTime timestamp, content string"
    rows = []
    for day in range(50):
        batch = [(f"f{day}_{i}", START + day * DAY, r.choice([f"day {day} {i}", f"again {i % 3}", f"day {max(day - 2, 0)} {i}"])) for i in range(20)]
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(str(tmp_path / f"feed/d{day:02}"))
        rows += batch
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed/*"))
    query = (
        seen.distinct_within(stream, "5 days")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(states) >= 50 and max(states) <= 20 * 12  # two horizons, and a batch at each end
    assert max(states[30:]) <= max(states[:25]) + 20  # it does not grow with the past
    got = [x["content"] for x in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(c for c in got if c.startswith("day")) == sorted({c for _, _, c in rows if c.startswith("day")})
    # these recur every day: let through once in ten to twelve days
    assert 3 * 4 <= sum(c.startswith("again") for c in got) <= 3 * 6


def test_registry_reads_its_buckets_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(seen, "BUCKET_DIGITS", 1)
    folder = str(tmp_path / "registry")
    seen.prepare_registry(spark, folder)
    schema = "filename string, sha256 string, md5 string"
    contents = [f"content {i}" for i in range(40)]
    first = [(f"b{i}", digest(c), "m") for i, c in enumerate(contents)] + [("a0", digest(contents[0]), "m")]
    for _ in range(2):  # a replay gives the same rows
        seen.register(spark.createDataFrame(first, schema), 0, folder)
    again = [("z", digest(contents[3]), "m"), ("y", digest("new"), "m"), ("x", digest("new"), "m")]
    seen.register(spark.createDataFrame(again, schema), 1, folder)
    rows = sorted((r["filename"], r["sha256"], r["batch_id"]) for r in seen.read_registry(spark, folder).filter("bucket <> 'none'").collect())
    assert rows == sorted([("a0", digest(contents[0]), 0), *((f"b{i}", digest(contents[i]), 0) for i in range(1, 40)), ("x", digest("new"), 1)])
    some = seen.read_registry(spark, folder, ["a", "3"], before=1)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r["sha256"][0] for r in some.collect()} <= {"a", "3"}
    compact = str(tmp_path / "compact")
    seen.compact_registry(spark, folder, compact, before=2)
    kept = seen.read_registry(spark, compact).filter("bucket <> 'none'")
    assert sorted((r["filename"], r["sha256"], r["batch_id"]) for r in kept.collect()) == sorted((n, s, 1) for n, s, _ in rows)


def test_stream_equals_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    r = random.Random(3)
    contents = [f"text {r.randint(0, 12)}" for _ in range(30)]
    for i, content in enumerate(contents):
        (landing / f"f{i:02}.txt").write_text(content)
    folder = str(tmp_path / "registry")
    for _ in range(2):
        seen.start_bucketed_registry(spark, str(landing), folder, str(tmp_path / "check"), max_files_per_trigger=7).awaitTermination()
        (landing / "late.txt").write_text(contents[0])
    got = [x["sha256"] for x in seen.read_registry(spark, folder).filter("bucket <> 'none'").collect()]
    assert sorted(got) == sorted({digest(c) for c in contents})
