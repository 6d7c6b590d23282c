"""The prefix trie against a plain trie."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

pytest.importorskip("dockhand.llm")

from dockhand.llm import prefix_trie  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth long, pos string, base int"


def plain(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in turns.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return [
        (m[0], len(n), members[n[:-1]][0] if n else None, len(m), children[n], leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends.get(n, []))).encode()).hexdigest())
        for n, m in members.items()
    ]


def check(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1, "", 2) for r in rows], SCHEMA).repartition(3)
    got = prefix_trie.prefix_trie(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)


def talks(seed, n, common=3, longest=9):
    r = random.Random(seed)
    said = ["hi", "", None, "é😀", "yes " * 3, "no"][: common + 1]
    return [
        (c, turn if r.random() > 0.05 else None, r.choice(["user", "assistant", None]) if r.random() < 0.2 else "user", r.choice(said))
        for c in range(n)
        for turn in range(r.randint(1, longest))
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_trie(spark, seed, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", (1024, 3)[seed - 1])
    monkeypatch.setattr(prefix_trie, "HOT", (1000, 5)[seed - 1])
    rows = talks(seed, 350)
    rows = [r for r in rows if r[0] not in (100, 205, 206)] + [(c, t, "user", "hi") for c in (-7, -100, -205) for t in range(3)]
    check(spark, rows + rows[:9] + [(None, 1, "user", "lost"), (12345678901, 0, "user", "x" * 200_000)])


def test_long_conversations_and_many_copies(spark, monkeypatch):
    """One conversation with most of the turns after the first three, and one sequence with most of the conversations."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 30_000, 100) for t in range(3)]
    check(spark, rows + [(7, t, "user", "go on") for t in range(150)] + [(9, t, "user", "go on") for t in range(120)])


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(df).collect() == []
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x", "", 1, "", 1)], SCHEMA)).collect() == []


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "m"]])
def test_running_sums_over_partitions(spark, keys):
    r = random.Random(5)
    rows = [(r.choice([1, 1, 1, 1, 2, 3]), r.randint(0, 1), i, r.randint(-5, 5), 1) for i in range(4_000)]
    df = spark.createDataFrame(rows, "k long, m long, at long, a long, b long")
    got = prefix_trie.running_sums(df, keys, ["at"], ["a", "b"]).orderBy(*keys, "at").collect()
    totals, want = collections.Counter(), []
    for row in sorted(rows, key=lambda x: (x[: len(keys)], x[2])):
        key = row[: len(keys)]
        totals[key, "a"] += row[3]
        totals[key, "b"] += 1
        want.append((*row, totals[key, "a"], totals[key, "b"]))
    assert [tuple(x) for x in got] == want


def test_ranks_a_list(spark):
    order = random.Random(6).sample(range(500), 500)
    rows = [(c, 0, n, None if n is None else 0, c % 3 + 1) for c, n in zip(order, [*order[1:], None], strict=True)]
    got = prefix_trie.ranked(spark.createDataFrame(rows, "conv_id long, code long, next_conv long, next_code long, weight long"))
    rest, want = 0, {}
    for c in reversed(order):
        rest += c % 3 + 1
        want[c] = rest
    assert {r["conv_id"]: r["to_end"] for r in got.collect()} == want


def test_ids_of_one_node_meet_as_texts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_IN_TEXT", 7)
    found = spark.range(3000).select(F.unhex(F.lit("00")).alias("key"), F.col("id").alias("conv_id"), F.lit(True).alias("last"))
    convs = spark.createDataFrame([], "conv_id long, length long")
    got = prefix_trie.ends_digests(found, convs).collect()
    assert [r["ends_sha256"] for r in got] == [hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()]
