"""Top-k search in many cells and pieces against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

pytest.importorskip("dockhand.llm")

from dockhand.llm import topk  # noqa: E402


def brute_force(queries, vectors, k):
    """(query id, vector id, score) by query and rank, of (id, components)."""
    out = []
    for i, q in queries:
        scores = sorted((-sum(a * b for a, b in zip(q, x, strict=True)), j) for j, x in vectors if j != i and len(x) == len(q))
        out += [(i, j, -s) for s, j in scores[:k]]
    return out


@pytest.mark.parametrize("largest", [2, 300, 1 << 28])
def test_pieces_give_the_same_as_all_pairs(monkeypatch, largest):
    r = random.Random(largest)
    for dense in (1, 32, 10**9):
        monkeypatch.setattr(topk, "DENSE", dense)
        monkeypatch.setattr(topk, "QUERIES_IN_BLOCK", 7)
        monkeypatch.setattr(topk, "VECTORS_IN_BLOCK", 40)
        monkeypatch.setattr(topk, "FIRST_VECTORS", 9)
        for dim, n in ((0, 30), (1, 100), (5, 3), (20, 200)):
            vectors = [(r.randint(0, 150), [r.randint(-largest, largest) for _ in range(dim)]) for _ in range(n)]
            vectors += [(1000 - i, x) for i, (_, x) in enumerate(vectors[:20])]
            queries = [(i, [r.randint(-largest, largest) for _ in range(dim)]) for i in r.sample(range(200), 20)]
            group = topk.Group(*(np.array(side, dtype=np.int64) for side in zip(*queries, strict=True)), 5)
            at = 0
            while at < len(vectors):
                piece = vectors[at : at + r.randint(1, 60)]
                group.add(np.array([i for i, _ in piece]), np.array([x for _, x in piece], dtype=np.int64).reshape(len(piece), dim))
                at += len(piece)
            got = [row for batch in group.best() for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            assert got == brute_force(queries, vectors, 5)


def test_no_side_passes_through_the_driver(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTORS_IN_BLOCK", 16)
    monkeypatch.setattr(topk, "VALUES_IN_GROUP", 200, raising=False)
    r = random.Random(11)
    ids = r.sample(range(2000), 300) + [50, 100, 150, 200]
    rows = [(i, [r.randint(-600, 600) / 256 for _ in range(3 if i % 3 else 12)]) for i in dict.fromkeys(ids)]
    rows += [(3000 + i, x) for i, x in rows[:40]] + [(-50, rows[0][1]), (None, rows[0][1])]
    df = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in df.collect())
    whole = [(i, [int(256 * v) for v in x]) for i, x in rows if i is not None]
    want = brute_force(sorted(q for q in whole if q[0] % 50 == 0), whole, 5)
    assert [(q, i, s) for q, _, i, s in got] == want and len(want) >= 25
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_cells_are_bounded_and_enough():
    n_q, n_x = topk._grid(64 * 720_000, 64 * 14_400, 720_000, 12)
    assert n_q == 1 and n_x == topk.CELLS_A_CORE * 12
    n_q, n_x = topk._grid(64 * 15_000_000, 64 * 300_000, 15_000_000, 12)
    assert 64 * 300_000 <= n_q * topk.VALUES_IN_GROUP and 64 * 15_000_000 <= n_x * topk.VALUES_IN_GROUP
    assert topk._grid(0, 0, 0, 12) == (1, 1)
