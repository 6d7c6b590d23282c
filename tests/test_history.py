"""The audit trail from states against brute force and snapshot differences."""

from __future__ import annotations

import random

import duckdb
import pytest

from dockhand.operators import history
from dockhand.operators.products import audit_changes
from dockhand.sources.versioned import VersionedTable

SCHEMA = "k long, Seq long, Deleted boolean, a string, b int"


def made(seed=3, n=160):
    r = random.Random(seed)
    return [(r.randint(0, 5), s, r.random() < 0.2, r.choice(["x", "y", None]), r.randint(0, 1)) for s in range(n)]


def snapshot(states, at):
    rows = {}
    for k, _, deleted, a, b in (s for s in sorted(states, key=lambda s: s[1]) if s[1] <= at):
        rows.pop(k, None)
        if not deleted:
            rows[k] = (k, a, b)
    return sorted(rows.values(), key=str)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A stream of batches out of order, with repeated states."""
    states = made()
    r = random.Random(1)
    shuffled = r.sample(states, len(states))
    batches = [shuffled[:50], shuffled[40:110], shuffled[100:], shuffled[:5]]
    folder = tmp_path_factory.mktemp("states")
    for at, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.parquet(str(folder / f"feed/b{at}"))
    table = history.create(VersionedTable(spark, str(folder / "t"), ["k", "Seq"]), spark.createDataFrame([], SCHEMA))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder / "feed/*"))
    for _ in range(2):
        history.start_history(stream, table, str(folder / "check")).awaitTermination()
    assert table.version() == 4
    return states, table.read().cache()


def test_rows_at_every_version(stored):
    states, table = stored
    for at in (-1, 0, 1, 7, 31, 90, 159, 500):
        assert sorted(map(tuple, history.as_of(table, at).collect()), key=str) == snapshot(states, at)


def test_the_trail_equals_differences_of_snapshots(spark, stored):
    states, table = stored
    got = {r["ValidFrom"]: (r["k"], r["a"], r["b"], r["Action"]) for r in history.changes(table).collect()}
    for at in range(160):
        before, after = ({r[0]: r for r in snapshot(states, v)} for v in (at - 1, at))
        k = next(s[0] for s in states if s[1] == at)
        if k in before and k in after and before[k] != after[k]:
            assert got[at] == (*after[k], "UPDATE")
        elif k in before and k not in after:
            assert got[at][0] == k and got[at][3] == "DELETE"
        elif k in after and k not in before:
            assert got[at] == (*after[k], "INSERT")
        else:
            assert at not in got
    old, new = (spark.createDataFrame(snapshot(states, v), "k long, a string, b int") for v in (30, 31))
    batch = [(r["k"], r["Action"]) for r in audit_changes(old, new, "k", ["a", "b"]).collect()]
    assert batch == ([(got[31][0], got[31][3])] if 31 in got else [])


def test_no_overlaps_or_gaps(stored):
    rows = history.changes(stored[1]).select("k", "ValidFrom", "ValidTo", "Action").toPandas()
    bad = duckdb.sql("""
        SELECT * FROM (SELECT *, lead(ValidFrom) OVER (PARTITION BY k ORDER BY ValidFrom) AS following FROM rows)
        WHERE following IS DISTINCT FROM ValidTo""").fetchall()
    assert len(rows) > 60 and bad == []


def test_equals_the_batch_form(spark, stored):
    states, table = stored
    want = history.trail(spark.createDataFrame(states, SCHEMA), "k")
    assert sorted(map(str, table.select(*want.columns).collect())) == sorted(map(str, want.collect()))
