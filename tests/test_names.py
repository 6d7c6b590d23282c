"""Names of several words: both ways of finding them against plain search."""

from __future__ import annotations

import functools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockhand.functions.text import tokens
from dockhand.operators import names
from dockhand.operators.names import build_trie, name_entities, walk


def by_force(text, names):
    """Leftmost-longest names by trying all of them at every word."""
    words, at, out = re.findall(r"[^\W\d_]+", (text or "").lower()), 0, Counter()
    parts = sorted({tuple(re.findall(r"[^\W\d_]+", n.lower())) for n in names if n} - {()}, key=len, reverse=True)
    while at < len(words):
        hit = next((p for p in parts if tuple(words[at : at + len(p)]) == p), None)
        if hit:
            out[" ".join(hit)] += 1
        at += len(hit) if hit else 1
    return out


def test_a_longer_name_that_fails_leaves_the_shorter():
    trie = build_trie([("a b c d", "X"), ("a b", "X"), ("b c", "Y"), ("c", "Z")])
    assert [n for n, _ in walk(trie, "a b c e a b c d b c a".split())] == ["a b", "c", "a b c d", "b c"]
    assert list(walk(trie, [])) == []


@pytest.mark.parametrize("most_names", [100_000, 0])
def test_overlapping_names(spark, most_names):
    rng = random.Random(7)
    names = [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 5))) for _ in range(60)] + ["New-York!", "Zürich West", "12", "", None, "a a a a a a a"]
    texts = [" ".join(rng.choice("abcdx") for _ in range(rng.randint(0, 80))) for _ in range(80)]
    texts += ["", None, "NEW\nYork, new york", "zürich 5 west", "a " * 3_000, texts[0]]
    docs = [(i, t, "clash", "clash") for i, t in enumerate(texts)] + [(0, texts[0], "clash", "clash"), (None, "c d new york", None, None)]
    listed = [(n, label) for n in names for label in ("P", "Q")] + [("x", None)]
    df = spark.createDataFrame(docs, "id long, text string, name string, label string").repartition(5)
    got = name_entities(df, spark.createDataFrame(listed, "name string, label string"), "id", most_names=most_names)
    assert got.columns == ["id", "name", "label", "n"]
    want = Counter((i, name, "P", n) for i, t, *_ in docs for name, n in by_force(t, names).items())
    assert Counter(map(tuple, got.collect())) == want
    nothing = name_entities(df, spark.createDataFrame([], "name string, label string"), "id", most_names=most_names)
    assert nothing.count() == 0 and name_entities(df.limit(0), df.select("name", "label"), "id", most_names=most_names).count() == 0


def test_texts_are_not_shuffled_for_a_list_that_can_be_sent(spark, checked):
    docs = spark.read.parquet(f"{checked}/documents.parquet")
    listed = spark.createDataFrame([("of the", "X")], "name string, label string")
    plan = name_entities(docs, listed, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
    assert "Exchange" in name_entities(docs, listed, "doc_id", most_names=0)._jdf.queryExecution().executedPlan().toString()


def test_a_longer_list_reads_a_long_text_in_proportion(spark):
    rng = random.Random(3)
    words = [rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(60_000)]
    names = [" ".join(words[at : at + n]) for n in (2, 3) for at in range(0, 60_000, 701)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[::-1])), (None, " ".join(words[:1]))], "id long, text string")
    listed = spark.createDataFrame([(n, "P") for n in names], "name string, label string")
    short, long = ({tuple(r) for r in name_entities(df, listed, "id", most_names=most).collect()} for most in (100_000, 0))
    assert long == short and len(long) > 100


def test_runs_of_words_do_not_leave_their_text_unless_they_pass_the_filter(spark):
    listed = spark.createDataFrame([("a b", "X"), ("c", "Y")], "name string, label string")
    bits = names._filter_of(names.normal_names(listed))
    assert np.unpackbits(bits).sum() == 2
    texts = spark.createDataFrame([(0, None), (1, "x a b c"), (2, "b a x y z")], "key long, text string").select("key", tokens(F.col("text")).alias("words"))
    found = names._joined(texts, names.normal_names(listed))
    assert {tuple(r) for r in found.collect()} == {(1, "a b", "X", 1), (1, "c", "Y", 1)}
    placed = texts.select(F.col("key").alias("row"), "key", "words", F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"))
    sent = spark.sparkContext.broadcast(bits)
    runs = placed.mapInArrow(functools.partial(names._runs, sent=sent, lengths=[1, 2]), "row long, key long, start int, name string")
    assert {tuple(r) for r in runs.collect()} == {(1, 1, 1, "a b"), (1, 1, 3, "c")}
