"""Levels and cycles of part structures against brute force."""

from __future__ import annotations

import random

import pytest

from dockhand.operators import bom, bom_cycles

SCHEMA = "ParentPartID bigint, ChildPartID bigint, Quantity bigint"


def reach(edges):
    out = {}
    for start in {x for e in edges for x in e}:
        seen, open_parts = set(), [start]
        while open_parts:
            part = open_parts.pop()
            for a, c in edges:
                if a == part and c not in seen:
                    seen.add(c)
                    open_parts.append(c)
        out[start] = seen
    return out


def cycles(edges):
    to = reach(edges)
    groups = {a: sorted(c for c in to[a] if a in to[c]) for a in to if a in to[a]}
    return sorted((g[0], a, len(g)) for a, g in groups.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_cycles_equal_brute_force(spark, seed):
    r = random.Random(seed)
    edges = {(r.randint(0, 40), r.randint(0, 40)) for _ in range(48)} | {(100 + i, 100 + (i + 1) % 6) for i in range(6)} | {(200, 200), (105, 0)}
    df = spark.createDataFrame([(a, c, 1) for a, c in edges] + [(None, 1, 1), (200, 200, 2)], SCHEMA)
    assert sorted(map(tuple, bom_cycles.bom_cycles(df).collect())) == cycles(edges)


def test_two_cycles_joined_by_a_way(spark):
    edges = {(1, 2), (2, 1), (2, 3), (3, 4), (4, 5), (5, 4), (5, 6), (0, 1)}
    df = spark.createDataFrame([(a, c, 1) for a, c in edges], SCHEMA)
    assert sorted(map(tuple, bom_cycles.bom_cycles(df).collect())) == [(1, 1, 2), (1, 2, 2), (4, 4, 2), (4, 5, 2)]
    assert sorted(map(tuple, bom_cycles.part_levels(df).collect())) == [(0, 0)]


def test_levels_are_longest_ways(spark):
    r = random.Random(7)
    edges = {(r.randint(0, child - 1), child) for child in range(1, 50) for _ in range(2)}
    longest = {}
    for child in range(50):
        parents = [a for a, c in edges if c == child]
        longest[child] = 1 + max(longest[a] for a in parents) if parents else 0
    df = spark.createDataFrame([(a, c, 1) for a, c in edges], SCHEMA)
    assert dict(map(tuple, bom_cycles.part_levels(df).collect())) == longest
    assert bom_cycles.bom_cycles(df).isEmpty()


def test_explosion_of_the_rest(spark):
    chain = [(i, i + 1, 2) for i in range(7)]
    loops = [(50, 51, 1), (51, 50, 1), (51, 70, 1), (2, 50, 1)]
    got, found = bom_cycles.explode_acyclic(spark.createDataFrame(chain + loops, SCHEMA))
    want = bom.explode_bom(spark.createDataFrame(chain, SCHEMA))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(r["PartID"] for r in found.collect()) == [50, 51]


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bom_cycles.bom_cycles(empty).isEmpty() and bom_cycles.part_levels(empty).isEmpty()
    assert bom_cycles.explode_acyclic(empty)[0].isEmpty()
