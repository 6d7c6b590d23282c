"""Tables changed by key, and the quantity view kept by signed changes."""

from __future__ import annotations

import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dockhand.operators import quantity_view
from dockhand.operators.products import product_part_quantity
from dockhand.sources.versioned import VersionedTable

SCHEMA = "k long, name string, n int"


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    made.create(spark.createDataFrame([(i, f"row {i}", i % 7) for i in range(4_000)], SCHEMA))
    yield made
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def digests(table, files):
    return {f: hashlib.sha256(Path(f.removeprefix("file:").replace("//", "/")).read_bytes()).hexdigest() for f in files}


def test_upsert_equals_a_full_rewrite(spark, table):
    before = table.files()
    kept = digests(table, before)
    changes = [(5, "five", 1, False), (6, "six", None, False), (9, None, None, True), (10**9, "new", 3, False), (10**9 + 1, None, None, True)]
    assert table.upsert(spark.createDataFrame(changes, SCHEMA + ", gone boolean"), deleted="gone")
    want = {i: (i, f"row {i}", i % 7) for i in range(4_000)} | {c[0]: c[:3] for c in changes}
    want = [v for k, v in want.items() if k not in (9, 10**9 + 1)]
    assert rows(table.read()) == sorted(want, key=str)
    after = table.files()
    untouched = set(before) & set(after)
    assert len(before) == 8 and len(untouched) == 7  # one file held the changed keys
    assert digests(table, untouched) == {f: kept[f] for f in untouched}
    assert rows(table.read(0)) == sorted(((i, f"row {i}", i % 7) for i in range(4_000)), key=str)


def test_update_leaves_other_columns_and_unknown_keys(spark, table):
    table.update(spark.createDataFrame([(3, -1), (77, None), (99_999, 5)], "k long, n int"))
    got = {r["k"]: (r["name"], r["n"]) for r in table.read().collect()}
    assert got[3] == ("row 3", -1) and got[77] == ("row 77", None) and 99_999 not in got and len(got) == 4_000


def test_a_failed_run_leaves_the_old_version(spark, table, monkeypatch):
    before, files = rows(table.read()), table.files()
    monkeypatch.setattr(table, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        table.upsert(spark.createDataFrame([(1, "x", 1)], SCHEMA))
    monkeypatch.undo()
    assert table.version() == 0 and table.files() == files and rows(table.read()) == before
    assert table.upsert(spark.createDataFrame([(1, "y", 1)], SCHEMA))
    assert table.version() == 1 and table.read().filter("k = 1").first()["name"] == "y"


def test_a_batch_is_applied_once(spark, table):
    change = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    assert table.upsert(change, batch=4) and not table.upsert(change, batch=4) and not table.upsert(change, batch=3)
    assert table.version() == 1 and table.batch() == 4


def test_bad_changes_are_refused(spark, table):
    for bad in ([(1, "x", 1), (1, "y", 1)], [(None, "x", 1)]):
        with pytest.raises(ValueError, match="NULL or is changed more than once"):
            table.upsert(spark.createDataFrame(bad, SCHEMA))
    assert table.version() == 0


def test_empty_tables_and_emptied_ones(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "e"), ["k"])
    made.create(spark.createDataFrame([], SCHEMA))
    assert made.read().collect() == []
    made.upsert(spark.createDataFrame([(1, "x", 1)], SCHEMA))
    made.upsert(spark.createDataFrame([(1, None, None, True)], SCHEMA + ", gone boolean"), deleted="gone")
    assert made.read().collect() == [] and made.version() == 2


def test_unlisted_files_go(spark, table):
    table.upsert(spark.createDataFrame([(1, "x", 1)], SCHEMA))
    want = rows(table.read())
    assert table.drop_unlisted() == 1 and rows(table.read()) == want


# ---- the quantity view

BOM = "ProductID long, PartID long, Quantity long"


def recomputed(spark, bill, parts):
    return rows(product_part_quantity(spark.createDataFrame(bill, BOM), parts).select("ProductID", "PartNumber", "TotalQuantity"))


@pytest.fixture
def parts(spark):
    return spark.createDataFrame([(i, f"PN-{i % 9}") for i in range(12)], "PartID long, PartNumber string")


def test_view_equals_recomputation_after_random_changes(spark, parts, tmp_path):
    r = random.Random(9)
    bill = [(r.randint(0, 15), r.randint(0, 13), r.choice([0, 1, 2, 5])) for _ in range(150)]
    view = quantity_view.create_view(spark.createDataFrame(bill, BOM), parts, str(tmp_path / "v"))
    for batch in range(3):
        old = list(bill)
        r.shuffle(bill)
        bill = bill[r.randint(5, 40) :]
        bill = [(p, q, n + 3) if r.random() < 0.1 else (p, q, n) for p, q, n in bill]
        bill += [(r.randint(0, 20), r.randint(0, 13), r.choice([0, 4])) for _ in range(12)] + bill[:3]
        changes = quantity_view.signed_changes(spark.createDataFrame(old, BOM), spark.createDataFrame(bill, BOM))
        assert quantity_view.apply_changes(view, changes, parts, batch)
        assert rows(view.read().drop("Uses")) == recomputed(spark, bill, parts)
        assert not quantity_view.apply_changes(view, changes, parts, batch)  # a replay
        assert rows(view.read().drop("Uses")) == recomputed(spark, bill, parts)
    assert view.read().filter("TotalQuantity = 0").count() > 0  # rows are left, though they sum to nothing


def test_view_follows_a_stream(spark, parts, tmp_path):
    bill = [(1, 1, 5), (1, 2, 5), (2, 1, 7)]
    view = quantity_view.create_view(spark.createDataFrame(bill, BOM), parts, str(tmp_path / "v"))
    feed = tmp_path / "feed"
    schema = BOM + ", sign int"
    for k, batch in enumerate([[(1, 1, 5, -1), (1, 1, 6, 1)], [(2, 1, 7, -1)], [(3, 3, 1, 1), (3, 3, 1, 1)]]):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(str(feed / f"b{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(feed / "*"))
    for _ in range(2):  # the second run finds nothing new
        quantity_view.start_quantity_view(stream, parts, view, str(tmp_path / "c")).awaitTermination()
    assert rows(view.read().drop("Uses")) == [(1, "PN-1", 6), (1, "PN-2", 5), (3, "PN-3", 2)]


def test_changes_are_computed_once_and_a_replay_not_at_all(spark, table):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = spark.createDataFrame([(i, "new", 1) for i in range(0, 4_000, 40)], SCHEMA)
    changes = source.mapInArrow(counted, source.schema)
    assert table.upsert(changes, batch=3) and read.value == 100
    assert not table.upsert(changes, batch=3) and read.value == 100
    assert table.read().filter("name = 'new'").count() == 100
