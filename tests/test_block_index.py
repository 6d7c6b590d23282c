"""The stored block index against brute force."""

from __future__ import annotations

import collections
import math
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dockhand.operators import block_index, search

SCHEMA = "doc_id long, text string, term string, block long"


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    words = [f"w{'abcdefghij'[i % 10] * (1 + i // 10)}" for i in range(60)]
    rows = {i: " ".join(r.choices(words, [1 / (1 + j) for j in range(60)], k=r.randint(0, 40))) for i in range(-40, 900)}
    rows |= {5: None, 6: "", 7: "!!", 8: "rare rare rare", 11: "rare", 10**12: "wa wb wa wb", 12: "É é wa", 13: "wa " * 5_000}
    for i in range(0, 900, 9):  # equal texts give equal scores
        rows[i] = "wa wb tie"
    return rows


@pytest.fixture(scope="module")
def stored(spark, texts, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in texts.items()] + [(None, "wa", "", 0)], SCHEMA).repartition(4)
    block_index.write_block_index(docs, folder, width=16)
    return block_index.BlockIndex(spark, folder)


def tokens(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def brute(texts, terms, n_docs):
    counts = {i: collections.Counter(tokens(t)) for i, t in texts.items()}
    df = {t: sum(t in c for c in counts.values()) for t in terms}
    scores = {i: sum(c[t] * math.log(n_docs / df[t]) for t in terms if c[t]) for i, c in counts.items() if any(c[t] for t in terms)}
    return sorted(((i, round(s, 6)) for i, s in scores.items()), key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("terms", [["wa"], ["tie", "RARE"], ["wa", "wj", "wcc"], ["é"], ["nowhere"], ["wa", "nowhere", "waaaaaa"]])
@pytest.mark.parametrize("k", [1, 25, 5_000])
def test_search_equals_brute_force(stored, texts, terms, k):
    got = [(r["doc_id"], r["score"]) for r in stored.search(terms, k).collect()]
    want = brute(texts, [t.lower() for t in terms], stored.n_docs)[:k]
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=2e-6)


def test_many_blocks_are_joined(stored, texts, monkeypatch):
    monkeypatch.setattr(block_index, "MOST_BLOCKS_NAMED", 3)
    got = [r["doc_id"] for r in stored.search(["wa", "wb"], 400).collect()]
    assert got == [i for i, _ in brute(texts, ["wa", "wb"], stored.n_docs)[:400]]


def test_blocks_are_skipped(stored, texts, monkeypatch):
    monkeypatch.setattr(block_index, "FIRST_BLOCKS", 4)
    first, others = stored.blocks_to_read(["wa", "wcc"], 3)
    read, every = len(first) + others.count(), stored.bounds(["wa", "wcc"]).count()
    assert every > 50 and read <= 8, (read, every)


def test_bounds_hold(stored, texts):
    bounds = {r["block"]: r["bound"] for r in stored.bounds(["wa", "wb", "rare"]).collect()}
    for i, score in brute(texts, ["wa", "wb", "rare"], stored.n_docs):
        assert score <= bounds[i // 16] + 1e-6


@pytest.mark.parametrize("phrase", ["wa wb", "wa wa", "wa wb tie", "rare rare", "wb wa wb", "wa nowhere", "tie"])
def test_phrases_equal_brute_force(stored, texts, phrase):
    words = phrase.split()
    want = {}
    for i, text in texts.items():
        found = tokens(text)
        n = sum(found[at : at + len(words)] == words for at in range(len(found)))
        if n:
            want[i] = n
    assert {r["doc_id"]: r["n"] for r in stored.phrase(words).collect()} == want


def test_the_filter_reaches_the_scan(stored):
    plan = stored.scores(["wa", "wb"], [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term, [wa,wb]), In(block, [1,2])" in plan.replace("IsNotNull(term), ", "")
    assert "positions" not in stored.bounds(["wa"])._jdf.queryExecution().executedPlan().toString()


def test_a_block_is_bounded_and_ordered(stored):
    rows = stored.blocks.select("term", "block", "n", "offsets").collect()
    assert max(r["n"] for r in rows) <= 16 and all(r["offsets"] == sorted(set(r["offsets"])) for r in rows)


def test_places_and_counts_agree(spark, checked):
    docs = spark.read.parquet(f"{checked}/documents.parquet")
    placed = block_index.placed_postings(docs).select("term", F.col("key").alias("doc_id"), F.size("places").cast("long").alias("tf"))
    plain = search.postings(docs).select("term", "doc_id", F.col("tf").cast("long").alias("tf"))
    assert placed.exceptAll(plain).isEmpty() and plain.exceptAll(placed).isEmpty()


def test_texts_are_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([(i, f"wa wb w{'c' * (i % 7)}") for i in range(300)], "doc_id long, text string").repartition(3)
    block_index.write_block_index(docs.mapInArrow(counted, docs.schema), str(tmp_path / "index"), width=16)
    assert read.value <= 2 * 300  # once for the parts and once for the size of the table
    assert block_index.BlockIndex(spark, str(tmp_path / "index")).search(["wa"], 400).count() == 300


def test_a_block_is_one_row_of_a_task(spark):
    docs = spark.createDataFrame([(i, "wa wb wa") for i in range(64)], "doc_id long, text string").coalesce(1)
    parts = block_index.block_parts(docs, width=16).collect()
    assert sorted((r.term, r.block, r.offsets) for r in parts) == [(t, n, list(range(16))) for t in ("wa", "wb") for n in range(4)]
    for r in parts:
        step, places = (2, [0, 2]) if r.term == "wa" else (1, [1])
        assert r.ends == list(range(step, 16 * step + 1, step)) and r.places == places * 16


def test_groups_of_words_and_rows_that_share_a_key(spark, monkeypatch):
    docs = spark.createDataFrame([(5, "a b a"), (-1, "b"), (5, "a"), (7, None), (6, "c a")], "doc_id long, text string").coalesce(1)
    want = [("a", 5, [0]), ("a", 5, [0, 2]), ("a", 6, [1]), ("b", -1, [0]), ("b", 5, [1]), ("c", 6, [0])]
    assert sorted(map(tuple, block_index.placed_postings(docs).collect())) == want
    one = block_index._parts(4)
    monkeypatch.setattr(block_index, "GROUP_WORDS", 2)
    words = pa.array([["a", "b", "a"], [], ["b"], ["a"], None], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([pa.array([5, 9, -1, 4, 3]), words], names=["key", "words"]).slice(0, 5)
    got = [
        (r["term"], r["block"], offset, r["places"][start:end])
        for out in one(iter([batch]))
        for r in out.to_pylist()
        for offset, start, end in zip(r["offsets"], [0, *r["ends"]], r["ends"])
    ]
    assert sorted(got) == [("a", 1, 0, [0]), ("a", 1, 1, [0, 2]), ("b", -1, 3, [0]), ("b", 1, 1, [1])]
