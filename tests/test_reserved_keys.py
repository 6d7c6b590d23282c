"""Keys of appended batches: dense, unique, the same after a replay or a failed run."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrameWriter

from dockhand.operators.reserved_keys import KeyedTable, start_keyed_append

ROWS = "v long, t string, __place long"
ORDER = ["v"]


def batch_of(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(6)]), rng.choice(["a", "", None]), rng.randint(0, 3)) for _ in range(n)]


def stored(table):
    return {r.k: (r.v, r.t, r.extra) for r in table.read().collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS).withColumnRenamed("__place", "extra").repartition(3)


def test_three_batches_one_replayed(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", start=10)
    assert table.read() is None and table.reservations().count() == 0
    batches, seen = {7: batch_of(1, 50), 3: [], 9: batch_of(2, 31)}, {}
    for number, rows in batches.items():
        assert table.append(frame(spark, rows), ORDER, number)
        now = stored(table)
        assert {k: now[k] for k in seen} == seen
        assert not table.append(frame(spark, rows), ORDER, number)
        assert stored(table) == now
        seen = now
    assert sorted(seen) == list(range(10, 91))
    low = lambda v: (v is not None, v or 0)
    values = [seen[k][0] for k in sorted(seen)]
    assert values[:50] == sorted((r[0] for r in batches[7]), key=low) and values[50:] == sorted((r[0] for r in batches[9]), key=low)
    assert {tuple(r) for r in table.reservations().collect()} == {(7, 10, 50), (3, 60, 0), (9, 60, 31)}


def test_a_failed_run_comes_again(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), "k")
    table.append(frame(spark, batch_of(3, 20)), ORDER, 0)
    before, write = stored(table), DataFrameWriter.parquet

    def breaks(self, path, *args, **kw):
        if "/rows/1" in path:
            raise RuntimeError("lost")
        return write(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", breaks)
    rows = batch_of(4, 30)
    with pytest.raises(RuntimeError):
        table.append(frame(spark, rows), ORDER, 1)
    monkeypatch.undo()
    assert stored(table) == before
    assert table.append(frame(spark, batch_of(5, 5)), ORDER, 2)  # another batch goes on after the reserved keys
    assert table.append(frame(spark, random.Random(1).sample(rows, len(rows))), ORDER, 1)
    after = stored(table)
    assert sorted(after) == list(range(1, 56)) and {k: after[k] for k in before} == before
    again = KeyedTable(spark, str(tmp_path / "u"), "k", start=21)
    again.append(frame(spark, rows), ORDER, 1)
    assert stored(again) == {k: after[k] for k in range(21, 51)}


def test_what_is_refused(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k")
    with pytest.raises(ValueError, match="column k"):
        table.append(spark.createDataFrame([(1,)], "k long"), ["k"], 0)
    spark.createDataFrame([(4, 1, 2)], "batch long, first long, held long").write.parquet(f"{table.folder}/reservations/4")
    with pytest.raises(ValueError, match="batch 4 reserved 2 keys"):
        table.append(frame(spark, batch_of(6, 3)), ORDER, 4)


def test_a_stream(spark, tmp_path):
    folder, table = tmp_path / "in", KeyedTable(spark, str(tmp_path / "t"), "k")
    total = 0
    for n in (12, 5):
        frame(spark, batch_of(n, n)).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema("v long, t string, extra long").parquet(str(folder))
        start_keyed_append(stream, table, ORDER, str(tmp_path / "c")).awaitTermination()
        total += n
        assert sorted(stored(table)) == list(range(1, total + 1))
