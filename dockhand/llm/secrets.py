"""Secret scans with password guess costs.

Fixed patterns give the base spans: assignments to a credential word, access
key ids and long hex runs. Beside them, values in a credential context are
weighed by dynamic programming: the cheapest segmentation into dictionary
words, dates, repeats, keyboard walks and brute-force spans tells how many
guesses the value takes, and a value that takes ``10 ** MIN_COST`` or more is a span
of kind ``guess``. Words are ranked by the vocabulary of a public tokenizer
(commonest first), after a few passwords everybody tries.

Spans are (kind, start, end) in code points, the end exclusive. Base spans
are the leftmost non-overlapping matches of their kind; a ``guess`` span is
the value alone.

Defined results: a null text is empty and has no spans; the digest of no spans
is that of the empty text; rows that repeat a document give a row each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush
from math import ceil, inf, log10

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import arrow, batches, text_of

# The base patterns and the least lengths of their matches.
ASSIGN = re.compile(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is taken whole, so shorter runs need not be matched
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "guess")

CONTEXT = re.compile(
    r"(?ai)(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_-]?key|access[_-]?key|private[_-]?key|auth)"
    r"[\"']?\x20*(?:=>|[:=]{1,2}|\x20is\x20|\x20was\x20)\x20*[\"']?([^\s\"'<>,;]+)"
)
MIN_COST = 8.0
TRIED = "password 123456 qwerty letmein admin welcome monkey dragon iloveyou abc123 master login secret changeme".split()
KEYS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LEET = str.maketrans("@430!1$57", "aaeoiisst")
MOST_WORD = 24
DATE = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:19|20)?\d\d"
    r"|(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)\d\d"
    r"|(?:19|20)\d\d"
)


def _neighbours() -> set[str]:
    """Ordered pairs of keys side by side or one below the other, by position in the rows."""
    pairs = set()
    for y, row in enumerate(KEYS):
        for x, key in enumerate(row):
            for dy, dx in ((0, 1), (1, 0), (1, -1)):
                if y + dy < len(KEYS) and 0 <= x + dx < len(KEYS[y + dy]):
                    other = KEYS[y + dy][x + dx]
                    pairs |= {key + other, other + key}
    return pairs


NEIGHBOURS = _neighbours()


@functools.lru_cache(maxsize=2)
def dictionary(vocabulary: str | None) -> dict[str, float]:
    """log10 rank of words: the tried passwords, then the whole words of a tokenizer file in its order."""
    ranks: dict[str, float] = {}
    words = list(TRIED)
    if vocabulary:
        from tokenizers import Tokenizer

        ids = Tokenizer.from_file(vocabulary).get_vocab(with_added_tokens=False)
        words += [w[:-4] for w, _ in sorted(ids.items(), key=lambda e: e[1]) if w.endswith("</w>")]
    for word in words:
        if len(word) >= 3 and word.isalnum() and word not in ranks:
            ranks[word] = log10(len(ranks) + 1)
    return ranks


def _alphabet(char: str) -> float:
    if char.isdigit():
        return 10
    if "a" <= char <= "z" or "A" <= char <= "Z":
        return 26
    return 33 if char.isascii() else 100


def _same(text: str, i: int, j: int) -> int:
    """How many characters from i on equal those from j on, i < j; compared in growing pieces."""
    done, piece = 0, 16
    while piece:
        if j + done + piece <= len(text) and text[i + done : i + done + piece] == text[j + done : j + done + piece]:
            done += piece
            piece *= 2
        else:
            piece //= 2
    return done


def guess_cost(value: str, ranks: dict[str, float], least: float = inf) -> float:
    """log10 guesses of the cheapest segmentation, ``inf`` if that is ``least`` or more.

    Costs: a word its rank, and a bit for capitals and for look-alike digits;
    a date 365.25 days times the years around 2000 (a year alone 100); a repeat its
    unit by brute force times the count; a keyboard walk of 3 or more keys
    the start, its length and a bit for each turn; else the alphabet of each
    character. Every segment but a character costs a factor of 2 for where it begins.

    Every word, date, repeat and walk is offered at every place that is reached for less than ``least``, so a
    value that takes many guesses is left after its first characters, however long it is. A unit
    of ``least`` characters costs too much by itself; a repeat may end after any of its last copies, where a segment
    that goes on beyond it can begin (with ``least`` infinite, after any).
    """
    lower = value.lower()
    if len(lower) != len(value):
        lower = value
    plain = lower.translate(LEET)
    step, size = log10(2), len(value)
    most_unit = size // 2 if least == inf else min(size // 2, ceil(least) - 1)
    tail = max(MOST_WORD, 2 * most_unit)
    cost, places = {0: 0.0}, [0]

    def offer(end: int, total: float) -> None:
        if total < least and total < cost.get(end, inf):
            if end not in cost:
                heappush(places, end)
            cost[end] = total

    while places:
        i = heappop(places)
        if i == size:
            break
        here = cost[i]
        offer(i + 1, here + log10(_alphabet(value[i])))
        here += step
        for j in range(i + 3, min(i + MOST_WORD, size) + 1):
            cased = step if value[i:j] != lower[i:j] else 0.0
            if (rank := ranks.get(lower[i:j])) is not None:
                offer(j, here + rank + cased)
            elif (rank := ranks.get(plain[i:j])) is not None:
                offer(j, here + rank + step + cased)
        if value[i].isdigit():
            for j in range(i + 4, min(i + 10, size) + 1):
                if DATE.fullmatch(value, i, j):
                    offer(j, here + (2.0 if j - i == 4 else log10(365.25 * 100)))
        brute = here
        for unit in range(1, min(most_unit, (size - i) // 2) + 1):
            brute += log10(_alphabet(value[i + unit - 1]))
            if brute >= least:
                break
            copies = 1 + _same(lower, i, i + unit) // unit
            for n in range(max(2, copies - tail // unit), copies + 1):
                offer(i + n * unit, brute + log10(n))
        turns, j = 0, i + 1
        while j < size and lower[j - 1 : j + 1] in NEIGHBOURS and here + turns * step < least:
            turns += j - i > 1 and _direction(lower, j - 2) != _direction(lower, j - 1)
            j += 1
            if j - i >= 3:
                offer(j, here + log10(40 * (j - i)) + turns * step)
    return cost.get(size, inf)


def _direction(text: str, at: int) -> tuple[int, int]:
    """From one key to the next, as rows and places."""
    (y1, x1), (y2, x2) = _PLACES[text[at]], _PLACES[text[at + 1]]
    return y2 - y1, x2 - x1


_PLACES = {key: (y, x) for y, row in enumerate(KEYS) for x, key in enumerate(row)}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the fixed patterns, by start and kind."""
    spans = []
    if ":" in text or "=" in text:
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def guess_spans(text: str, ranks: dict[str, float], least: float = MIN_COST) -> list[tuple[str, int, int]]:
    """Values in a credential context that take many guesses."""
    if ":" not in text and "=" not in text and " is " not in (lower := text.lower()) and " was " not in lower:
        return []  # every context needs one of these, in either case
    spans = []
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".!?)]}")
        if len(value) >= LEAST_ASSIGN and guess_cost(value, ranks, least) >= least:
            spans.append(("guess", m.start(1), m.start(1) + len(value)))
    return spans


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


OUT = arrow("doc_id long,n_assign long,n_access long,n_hex long,base_sha256 string,spans string,n_guess long")


def find_secrets(docs: DataFrame, vocabulary: str | None = None, least: float = MIN_COST) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess."""

    def scan(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = dictionary(vocabulary)
        for batch in source:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                base = base_spans(text)
                extra = guess_spans(text, ranks, least)
                n = [sum(s[0] == kind for s in base) for kind in KINDS[:3]]
                spans = sorted(base + extra, key=lambda s: (s[1], KINDS.index(s[0])))
                rows.append((doc_id, *n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(extra)))
            yield from batches(rows, OUT)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(
        scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long"
    )
