"""Byte-level BPE against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
from array import array

import duckdb
import pytest

pytest.importorskip("dockhand.llm")

import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from dockhand.llm import bpe  # noqa: E402
from dockhand.llm.queries import QUERIES  # noqa: E402

CHECKED = "/root/testdata/sf0.01"
PATH = public_tokenizers.path(bpe.FILE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    text = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_pieces_of_every_character(library):
    settled = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not bpe.unsettled().match(chr(c))]
    for at in range(0, len(settled), 500):
        text = "".join(f"a{c}a {c}1{c}!{c}  " for c in settled[at : at + 500])
        assert bpe.PIECES.findall(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)], at


def test_odd_texts_equal_the_library(library):
    r = random.Random(3)
    parts = ["a", "b", "the ", " ", "  ", "\n", "\x1c", "\x85", "　", "é", "日本", "<|endoftext|>", "<|endof", "'s", "'S", "don't", "12", "٠", "!?", "😀"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 40))) + "x" * r.randint(0, 80) for _ in range(1500)]
    texts += ["", "x" * 20_000, "ab" * 9_000, " " * 5_000, "aaaa", "aaaaa", "'" * 999, "".join(r.choices("etaoin", k=50_000))]
    vocabulary = bpe.vocabulary_of(PATH)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert array("i", vocabulary.encode(text)).tolist() == want.ids
        assert vocabulary.decode(want.ids) == library.decode(want.ids, skip_special_tokens=False) == text


def test_decodes_any_ids(library):
    r = random.Random(4)
    vocabulary = bpe.vocabulary_of(PATH)
    for _ in range(500):
        ids = r.choices(range(50_257), k=12)
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert vocabulary.decode([-5, 10**6]) == ""


def test_the_table_equals_the_library(spark, library):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{CHECKED}/documents.parquet'").fetchall()
    got = QUERIES["op11_bpe_coding"](spark, CHECKED).collect()
    assert sorted(map(tuple, got)) == sorted((i, *digests(library, t)) for i, t in rows)


def test_odd_rows(spark, library):
    texts = [None, "", " \t\n", "a b", "a b", "x" * 300_000, "é <|endoftext|> 'tis\x00"]
    rows = [(i, t, "clash", [1]) for i, t in enumerate(texts)] + [(3, "other", "", None), (None, "lost id", "", [2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>")
    got = bpe.round_trip(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((r[0], *digests(library, r[1])) for r in rows), key=str)
    assert bpe.round_trip(df.limit(0)).collect() == []
    ids = spark.createDataFrame([(1, None), (2, []), (3, [50256, 64])], "k long, ids array<int>")
    assert {r["k"]: r["decoded"] for r in bpe.decode(ids).collect()} == {1: None, 2: "", 3: "<|endoftext|>a"}


def test_batches_of_ids_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(bpe, "IDS_IN_BATCH", 10)
    import pyarrow as pa

    texts = ["one two three " * k for k in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array([t.encode() for t in texts])], names=["k", "t"])
    out = list(bpe._encode(None, 1)(iter([batch])))
    assert len(out) > 30 and [k for b in out for k in b.column(0).to_pylist()] == list(range(40))
    back = [t for b in bpe._decode(None)(iter(out)) for t in b.column(2).to_pylist()]
    assert back == texts
