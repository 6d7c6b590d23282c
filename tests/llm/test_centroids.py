"""Centroid clustering against SQL and a plain reference."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

pytest.importorskip("dockhand.llm")

from dockhand.llm import centroids  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, cluster int, e string"


def plain(rows, clusters, components, rounds):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), e) for i, e in kept)
    middle = [e for _, e in order[:clusters]]

    def near(e):
        return min((sum((x - y) ** 2 for x, y in zip(e, c, strict=True)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, e in kept:
            groups.setdefault(near(e)[1], []).append(e)
        middle = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else m for k, m in enumerate(middle)]
    out = [(i, near(e)[1], near(e)[0]) for i, e in kept]
    whole = sum(d for _, _, d in out)
    return [
        (i, k, d, sum(b for _, a, b in out if a == k), whole, hashlib.sha256(",".join(map(str, middle[k])).encode()).hexdigest())
        for i, k, d in out
    ]


@pytest.fixture(scope="module")
def odd_vectors():
    r = random.Random(8)
    grid = [-1.5, -0.25, 0.0, 0.001, 0.5, 2.0]
    rows = [(i, [r.choice(grid) for _ in range(4)]) for i in range(120)]
    rows += rows[:15] + [(None, [0.5] * 4), (None, [-0.5] * 4), (7, [9.0] * 4), (200, [1.0] * 3), (201, []), (202, None)]
    return rows + [(203, [1.0, None, 1.0, 1.0]), (204, [float("nan")] * 4), (205, [float("inf"), 0.0, 0.0, 0.0])]


@pytest.mark.parametrize("clusters", [1, 7, 60, 500])
def test_equals_plain_clustering(spark, odd_vectors, clusters):
    df = spark.createDataFrame([(*r, 1, "clash") for r in odd_vectors], SCHEMA).repartition(3)
    got = centroids.clusters_of(df, clusters=clusters, components=4, rounds=3).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(odd_vectors, clusters, 4, 3), key=str)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    nothing = spark.createDataFrame([(1, None, 1, ""), (2, [0.5], 1, "")], SCHEMA)
    full = centroids.clusters_of(spark.createDataFrame([(1, [0.5] * 64, 1, "")], SCHEMA))
    for df in (empty, nothing):
        got = centroids.clusters_of(df)
        assert got.collect() == [] and got.dtypes == full.dtypes
    assert full.collect()[0][:5] == (1, 0, 0, 0, 0)


def test_too_many_numbers_are_refused(spark):
    with pytest.raises(ValueError, match="numbers of centroids"):
        centroids.clusters_of(spark.createDataFrame([], SCHEMA), clusters=10_000)


def test_the_plan_has_no_python(spark, odd_vectors):
    df = spark.createDataFrame([(*r, 1, "") for r in odd_vectors], SCHEMA)
    plan = centroids.assigned(centroids.integer_vectors(df, 4), [[0] * 4, [1] * 4])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
