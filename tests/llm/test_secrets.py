"""Guess costs against all segmentations, and base spans against the plain patterns on whole documents."""

from __future__ import annotations

import functools
import random
import re
import time
from math import inf, log10

import pytest

from dockhand.llm import secrets
from dockhand.llm.queries import QUERIES

RANKS = {"abc": 0.0, "pass": 1.0, "sea": 0.5, "aaa": 1.5, "qwe": 2.0, "assa": 0.3}
TWO = log10(2)


def segment_costs(part: str):
    """Costs of a piece taken as one segment, by the definition of each kind."""
    lower = part.lower()
    alphabet = [10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100 for c in part]
    if len(part) == 1:
        yield log10(alphabet[0])
    plain = "".join({"@": "a", "4": "a", "3": "e", "0": "o", "!": "i", "1": "i", "$": "s", "5": "s", "7": "t"}.get(c, c) for c in lower)
    capitals = TWO if part != lower else 0.0
    if lower in RANKS:
        yield TWO + RANKS[lower] + capitals
    elif plain in RANKS:
        yield TWO + RANKS[plain] + capitals + TWO
    if secrets.DATE.fullmatch(part):
        yield TWO + (2.0 if len(part) == 4 else log10(36525))
    for unit in range(1, len(part) // 2 + 1):
        if len(part) % unit == 0 and lower == lower[:unit] * (len(part) // unit):
            yield TWO + sum(map(log10, alphabet[:unit])) + log10(len(part) // unit)
    if len(part) >= 3 and all(part.lower()[k : k + 2] in secrets.NEIGHBOURS for k in range(len(part) - 1)):
        place = {c: (y, x) for y, row in enumerate(secrets.KEYS) for x, c in enumerate(row)}
        moves = [(place[b][0] - place[a][0], place[b][1] - place[a][1]) for a, b in zip(lower, lower[1:])]
        yield TWO + log10(40 * len(part)) + TWO * sum(m != n for m, n in zip(moves, moves[1:]))


def by_force(value: str) -> float:
    @functools.lru_cache(None)
    def rest(at: int) -> float:
        if at == len(value):
            return 0.0
        return min(cost + rest(end) for end in range(at + 1, len(value) + 1) for cost in segment_costs(value[at:end]))

    return rest(0)


ALPHABETS = ["a", "ab", "as", "qwas", "abcps$E1", "0129", "12-0", "passeabc@5", "qwertyQ1", "é a1"]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_cost_is_the_least_of_all_segmentations(alphabet):
    rng = random.Random(alphabet)
    for _ in range(150):
        unit = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9)))
        value = unit * rng.randint(1, 3) + "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 5)))
        want = by_force(value)
        assert secrets.guess_cost(value, RANKS) == pytest.approx(want), value
        for least in (2.5, 4.0, 8.0):
            got = secrets.guess_cost(value, RANKS, least)
            assert got == pytest.approx(want) if want < least - 1e-9 else got == inf or want < least + 1e-9, (value, least)


@pytest.mark.parametrize("value", ["a" * 60 + "abc", "ab" * 40 + "cpass", "qw" * 30 + "er", "2001" * 20 + "-01-02", "abcdefghi" * 3])
def test_long_repeats(value):
    want = by_force(value)
    assert secrets.guess_cost(value, RANKS) == pytest.approx(want)
    assert secrets.guess_cost(value, RANKS, 8.0) == (pytest.approx(want) if want < 8 else inf)


def test_very_long_values_take_no_time():
    start = time.monotonic()
    ranks = secrets.dictionary(None)
    rng = random.Random(1)
    noise = "".join(rng.choice("abcdefXYZ0189-") for _ in range(5_000_000))
    for value in (noise, "a" * 5_000_000, "qw" * 2_500_000, "password" * 600_000, "12345678" * 600_000 + "x"):
        secrets.guess_cost(value, ranks, secrets.MIN_COST)
    assert time.monotonic() - start < 20


def test_case_of_the_context_and_other_marks_do_not_matter():
    ranks = secrets.dictionary(None)
    for text in ("THE PASSWORD IS Zk8qLw92Tx", "x: THE PASSWORD IS Zk8qLw92Tx", "the password was Zk8qLw92Tx."):
        assert [k for k, *_ in secrets.guess_spans(text, ranks)] == ["guess"]


def test_base_spans_of_all_documents(spark, checked):
    """The patterns as the contract writes them, tried one after another on every whole text."""
    patterns = [
        ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ]
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{checked}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op2_secret_scan"](spark, checked).collect()
    assert len(rows) == len(texts)
    for row in rows:
        found = [[(kind, m.start(), m.end()) for m in re.finditer(p, texts[row.doc_id]) if good(m)] for kind, p, good in patterns]
        assert [row.n_assign, row.n_access, row.n_hex] == list(map(len, found))
        spans = {f"{k}:{a}:{b}" for of in found for k, a, b in of}
        assert spans == {s for s in row.spans.split(",") if s and not s.startswith("guess")}
