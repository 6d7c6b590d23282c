"""Word shingles of whole texts as sets of 64-bit fingerprints, in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WORDS_IN_SHINGLE = 4
SPACES = b" \t\n\x0b\x0c\r"
GROUP_BYTES = 1 << 19

_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(SPACES)] = True
_random = np.random.default_rng(20_240_117)
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_PLACES = _random.integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as needed."""

    def __init__(self):
        self.up, self.down = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            up, down = np.full(n, _BASE, dtype=np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)


_powers = _Powers()


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z in lower case, and the number of words of each text."""
    data = np.frombuffer(b" ".join(t.lower() for t in texts) + b" ", dtype=np.uint8)
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    _powers.reach(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * _powers.up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers.down[starts] + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
    return hashes, counts


def groups(texts: Sequence[bytes], size: int = GROUP_BYTES) -> Iterator[list[int]]:
    """Positions of texts in runs of about ``size`` bytes."""
    run, held = [], 0
    for i, text in enumerate(texts):
        run.append(i)
        held += len(text)
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def shingle_sets(texts: Sequence[bytes], k: int = WORDS_IN_SHINGLE) -> list[np.ndarray]:
    """Sorted distinct fingerprints of each text's ``k``-word shingles.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    out: list[np.ndarray] = []
    for run in groups(texts):
        hashes, counts = word_hashes([texts[i] for i in run])
        n = max(len(hashes) - k + 1, 0)
        rolled = np.zeros(n, dtype=np.uint64)
        for place in range(k):
            rolled += hashes[place : place + n] * _PLACES[place]
        rolled = mix(rolled)
        at = 0
        for count in counts.tolist():
            if count >= k:
                out.append(np.unique(rolled[at : at + count - k + 1]))
            elif count:
                short = (hashes[at : at + count] * _PLACES[:count]).sum(dtype=np.uint64) + np.uint64(count)
                out.append(mix(np.array([short], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            at += count
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))
