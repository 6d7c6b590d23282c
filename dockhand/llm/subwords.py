"""Subword ids of whole texts by a public tokenizer file, with a cache of words."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import itertools
import os
import re
import string
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

from dockhand.llm.shingles import SPACES, groups

# A word is looked up without the punctuation after it, which this tokenizer
# always cuts off. Quotes and angle brackets may join with letters or form
# special tokens, so words with them are looked up whole.
TAIL = b".,;:!?#$%&*()[]{}/=+-_~^@"
CACHED_WORDS = 400_000
GROUP_BYTES = 4 << 20
BLANK = re.compile(b"[" + SPACES + b"]")


def _among(values: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(values)] = True
    return out


_IS_BLANK, _IS_TAIL = _among(SPACES), _among(TAIL)
_IS_LETTER = _among(string.ascii_letters.encode() + bytes(range(128, 256)))  # bytes of other characters may be letters
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def gathered(flat: np.ndarray, lengths: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The values of parts given by number, one after another; ``flat`` holds the parts, ``lengths`` how long each is."""
    own = lengths[index]
    ends = np.cumsum(own)
    if not len(ends):
        return flat[:0]
    starts = np.cumsum(lengths) - lengths
    return flat[np.arange(ends[-1]) + np.repeat(starts[index] - (ends - own), own)]


def _distinct(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.BinaryArray]:
    """Byte strings that lie one after another as numbers of the distinct ones."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))]
    found = pa.Array.from_buffers(pa.binary(), len(lengths), buffers).dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def _bounds(words: pa.BinaryArray) -> tuple[np.ndarray, bytes]:
    """Where byte strings begin and end in a run of bytes, and the run."""
    _, offsets, values = words.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    return at.astype(np.int64) - at[0], values[at[0] : at[-1]].to_pybytes() if values is not None else b""


def _listed(words: pa.BinaryArray) -> list[bytes]:
    at, raw = _bounds(words)
    return [raw[a:b] for a, b in itertools.pairwise(at.tolist())]


def _parts(text: bytes, size: int) -> Iterator[bytes]:
    """A text cut at white space into parts of little more than ``size`` bytes."""
    at = 0
    while len(text) - at > size and (blank := BLANK.search(text, at + size)):
        yield text[at : blank.start()]
        at = blank.end()
    yield text[at:]


class WordIds:
    """Ids of a text as one uint16 array, equal to encoding the whole text.

    The tokenizer never joins anything across ASCII white space, so the distinct
    words of a group of texts are encoded one by one, letters apart from the
    punctuation after them. Letters, punctuation and other words are kept;
    a cache is emptied when it holds ``cached`` entries.
    """

    def __init__(self, vocabulary: str, cached: int = CACHED_WORDS):
        self.cached = cached
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        if max(words.values()) > 0xFFFF:
            raise ValueError("the vocabulary has more than 65,536 ids")
        self.ends = np.zeros(1 << 16, dtype=bool)
        self.ends[[i for word, i in words.items() if word.endswith("</w>")]] = True
        self.cores: dict[bytes, bytes] = {}  # empty: not letters only
        self.tails: dict[bytes, bytes] = {}
        self.whole: dict[bytes, bytes] = {}

    def _encode(self, words: Sequence[str]) -> list[bytes]:
        return [
            np.array(e.ids, dtype=np.uint16).tobytes()
            for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        ]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """Words of letters only: each ends with the one id that closes a word."""
        out: list[bytes] = []
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, dtype=np.uint16)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part) or stops[-1] != len(ids):
                out += self._encode(part)
                continue
            raw, start = ids.tobytes(), 0
            for stop in (stops * 2).tolist():
                out.append(raw[start:stop])
                start = stop
        return out

    def _encode_cores(self, cores: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words of letters; a-z needs the model alone, as nothing is normalised or cut there."""
        found: dict[bytes, bytes] = {}
        others: dict[bytes, str] = {}
        tokenize = self.model.tokenize
        for core in cores:
            text = core.decode("utf-8", "replace")
            if core.isascii():
                found[core] = array("H", [token.id for token in tokenize(text)]).tobytes()
            elif text.isalpha():
                others[core] = text
            else:
                found[core] = b""
        found.update(zip(others, self._encode_letters(list(others.values())), strict=True))
        return found

    def _look_up(self, cache: dict[bytes, bytes], words: pa.BinaryArray, encode: Callable[[list[bytes]], dict[bytes, bytes]], keep: bool) -> list[bytes]:
        if len(cache) > self.cached:
            cache.clear()
        wanted = _listed(words)
        new = encode([word for word in wanted if word not in cache])
        if keep:
            cache.update(new)
            return list(map(cache.__getitem__, wanted))
        return [cache[word] if word in cache else new[word] for word in wanted]

    def _spell(self, words: pa.BinaryArray, keep: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after another, and how many each word has."""
        at, raw = _bounds(words)
        raw = np.frombuffer(raw, dtype=np.uint8)
        begin, end = at[:-1], at[1:]
        solid = np.concatenate([[-1], np.flatnonzero(~_IS_TAIL[raw])])
        stop = np.maximum(solid[np.searchsorted(solid, end) - 1] + 1, begin)
        odd = np.concatenate([[0], np.cumsum(~_IS_LETTER[raw])])
        high = np.concatenate([[0], np.cumsum(raw >= 128)])
        plain = (stop > begin) & (odd[stop] == odd[begin])
        lengths = end - begin
        raw = np.where(np.repeat(high[stop] == high[begin], lengths), _LOWER[raw], raw)
        inside = np.arange(len(raw)) < np.repeat(stop, lengths)
        of_plain = np.repeat(plain, lengths)
        core_of, cores = _distinct(raw[inside & of_plain], (stop - begin)[plain])
        tail_of, tails = _distinct(raw[~inside & of_plain], (end - stop)[plain])
        encoded = lambda new: dict(zip(new, self._encode([w.decode("utf-8", "replace") for w in new]), strict=True))
        core_ids = self._look_up(self.cores, cores, self._encode_cores, keep)
        tail_ids = self._look_up(self.tails, tails, encoded, keep)
        letters = np.fromiter(map(len, core_ids), dtype=np.int64, count=len(core_ids))[core_of] > 0
        joined = np.flatnonzero(plain)[letters]
        rest = np.ones(len(words), dtype=bool)
        rest[joined] = False
        rest = np.flatnonzero(rest)
        parts = [b"", *core_ids, *tail_ids, *self._look_up(self.whole, words.take(pa.array(rest)), encoded, keep)]
        first, second = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        first[joined] = 1 + core_of[letters]
        second[joined] = 1 + len(core_ids) + tail_of[letters]
        first[rest] = 1 + len(core_ids) + len(tail_ids) + np.arange(len(rest))
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 2
        both = np.stack([first, second], axis=1).ravel()
        return gathered(np.frombuffer(b"".join(parts), dtype=np.uint16), sizes, both), sizes[first] + sizes[second]

    def _group(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        blank = _IS_BLANK[data]
        edge = np.flatnonzero(np.diff(blank, prepend=True))
        starts, ends = edge[::2], edge[1::2]
        index, words = _distinct(data[~blank], ends - starts)
        flat, lengths = self._spell(words)
        bounds = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])[:-1])
        places = np.concatenate([[0], np.cumsum(lengths[index])])
        return np.split(gathered(flat, lengths, index), places[bounds])

    def ids(self, texts: Sequence[bytes], size: int = GROUP_BYTES) -> list[np.ndarray]:
        """Ids of each text, given as UTF-8; about ``size`` bytes are looked up together."""
        out: list[np.ndarray] = []
        for run in groups(texts, size):
            if sum(len(texts[i]) for i in run) > 2 * size:  # the last one is long
                out += self._group([texts[i] for i in run[:-1]]) if run[:-1] else []
                out.append(np.concatenate([self._group([part])[0] for part in _parts(texts[run[-1]], size)]))
            else:
                out += self._group([texts[i] for i in run])
        return out

    def word_ids(self, words: Sequence[bytes], kept: int, step: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after another, and how many each word has; only the first ``kept`` enter the caches."""
        found = [self._spell(pa.array(words[at : at + step], pa.binary()), at < kept) for at in range(0, len(words), step)]
        if not found:
            return np.zeros(0, dtype=np.uint16), np.zeros(0, dtype=np.int64)
        flat, lengths = zip(*found, strict=True)
        return np.concatenate(flat), np.concatenate(lengths)


@functools.cache
def shared_ids(vocabulary: str, cached: int) -> WordIds:
    """One for all tasks of a process, which so find the words that were looked up before."""
    return WordIds(vocabulary, cached)


def forget() -> None:
    """Give back the memory of shared tokenizers and their caches, in stages that have no use for them."""
    shared_ids.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library can return freed pages
        ctypes.CDLL(None).malloc_trim(0)
