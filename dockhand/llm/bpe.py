"""Byte-level BPE: encoding by a queue of merge ranks, decoding by vocabulary strings.

A text is cut at the added tokens of the vocabulary file and then into pieces
by the file's byte-level rule. A piece is a doubly linked list of symbols, one
per byte at first. A priority queue holds (rank of the merge, place) of every
pair that may be merged; the lowest is taken, and skipped as stale where a
symbol is gone or the pair has changed since. A merge links its neighbours and
queues the two pairs it makes. That takes some 50 bytes for each byte of the
piece at hand, which is a run of letters, digits, signs or white space.
Decoding concatenates the bytes of the vocabulary strings.

Pieces of up to ``CACHED_LENGTH`` characters are remembered per process, up to
``CACHED_PIECES`` of them. A text never leaves its row: there is no shuffle.

Defined results: a null or empty text has no ids and decodes to the empty
text; bytes that are no UTF-8 count as replacement characters; null ids decode
to a null text, ids outside the vocabulary to nothing; rows that repeat a key
are encoded each; an empty table gives no rows; other columns than the named
ones are not read.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import text_of

FILE = "byte_bpe_50k.json"
CACHED_PIECES = 400_000
CACHED_LENGTH = 64
IDS_IN_BATCH = 2_000_000
PAIR = 21  # bits of a symbol in the key of a pair
PLACE = 32  # bits of a place in an entry of the queue
LOW = (1 << PLACE) - 1
GONE = -1
COMPACT = functools.partial(array, "i")  # for long pieces; lists are faster for short ones

# Fixed: the pieces that byte-level vocabularies are made of, for ASCII texts and for all.
ASCII_PIECES = re.compile(
    r"'(?:[stmd]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^A-Za-z0-9 \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
)
PIECES = regex.compile(
    r"'(?:[stmd]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else the next one from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in prints else next(others)) for b in range(256)]


@functools.cache
def unsettled() -> re.Pattern:
    """Characters that are letters or numbers by one Unicode version only, and all beyond U+FFFF."""
    import unicodedata

    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    new = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c)[0] not in "LN"]
    return re.compile("[" + "".join(map(re.escape, new)) + "\U00010000-\U0010ffff]")


class Vocabulary(dict):
    """A vocabulary file; as a mapping, the ids (int32 bytes) of every piece that was met."""

    def __init__(self, path: str):
        super().__init__()
        self.path = path
        with open(path, encoding="utf-8") as file:
            declared = json.load(file)
        model, added = declared["model"], declared.get("added_tokens") or []
        if model["type"] != "BPE" or (declared.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("not a byte-level BPE vocabulary")
        if any(model.get(key) for key in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError("the vocabulary asks for rules that are not supported")
        if declared.get("normalizer") or declared["pre_tokenizer"].get("add_prefix_space") or not declared["pre_tokenizer"].get("use_regex", True):
            raise ValueError("the vocabulary asks for rules that are not supported")
        if any(token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in their surroundings are not supported")
        ids: dict[str, int] = model["vocab"]
        characters = byte_characters()
        self.byte_ids = [ids[c] for c in characters]
        self.ranks: dict[int, int] = {}
        self.made = array("i")
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[ids[left] << PAIR | ids[right]] = rank
            self.made.append(ids[left + right])
        self.added = {token["content"]: token["id"] for token in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_rule = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        byte_of = {c: b for b, c in enumerate(characters)}
        strings = {i: s for s, i in ids.items()} | {i: s for s, i in self.added.items()}
        self.strings = [b""] * (max(strings) + 1)
        for i, s in strings.items():
            self.strings[i] = bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode()

    def merged(self, piece: bytes) -> array:
        """Ids of one piece."""
        ranks, made_by = self.ranks.get, self.made
        n = len(piece)
        held = list if n <= CACHED_LENGTH else COMPACT
        symbols = held(map(self.byte_ids.__getitem__, piece))
        wanted = held([GONE]) * n  # the rank that the pair at a place waits with
        queue = []
        for at in range(n - 1):
            rank = ranks(symbols[at] << PAIR | symbols[at + 1])
            if rank is not None:
                queue.append(rank << PLACE | at)
                wanted[at] = rank
        if not queue:
            return array("i", symbols)
        heapq.heapify(queue)
        after, before = held(range(1, n + 1)), held(range(-1, n - 1))
        while queue:
            rank, at = (top := heapq.heappop(queue)) >> PLACE, top & LOW
            if wanted[at] != rank:
                continue  # stale: a symbol is gone, or the pair has changed since
            right = after[at]
            symbols[at], symbols[right] = (made := made_by[rank]), GONE
            after[at] = follower = after[right]
            wanted[at] = wanted[right] = GONE
            if follower < n:
                before[follower] = at
                rank = ranks(made << PAIR | symbols[follower])
                if rank is not None:
                    heapq.heappush(queue, rank << PLACE | at)
                    wanted[at] = rank
            if (left := before[at]) >= 0:
                rank = ranks(symbols[left] << PAIR | made)
                wanted[left] = GONE if rank is None else rank
                if rank is not None:
                    heapq.heappush(queue, rank << PLACE | left)
        return array("i", (s for s in symbols if s != GONE))

    def __missing__(self, piece: str) -> bytes:
        ids = self.merged(piece.encode()).tobytes()
        if len(piece) <= CACHED_LENGTH:
            self[piece] = ids
        return ids

    @functools.cached_property
    def library(self):
        """The library's own reading of the file, for characters that Unicode versions class differently."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path).pre_tokenizer

    def pieces(self, text: str) -> list[str]:
        if text.isascii():
            return ASCII_PIECES.findall(text)
        if unsettled().search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return PIECES.findall(text)

    def encode(self, text: str) -> bytes:
        """Ids of a text, int32 in the order of this machine."""
        if len(self) > CACHED_PIECES:
            self.clear()
        if not self.added_rule:
            return b"".join(map(self.__getitem__, self.pieces(text)))
        out = []
        for k, part in enumerate(self.added_rule.split(text)):
            if k % 2:
                out.append(array("i", [self.added[part]]).tobytes())
            elif part:
                out += map(self.__getitem__, self.pieces(part))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        strings, n = self.strings, len(self.strings)
        if ids and (max(ids) >= n or min(ids) < 0):
            ids = [i for i in ids if 0 <= i < n]
        return b"".join(map(strings.__getitem__, ids)).decode("utf-8", "replace")


@functools.cache
def vocabulary_of(path: str | None) -> Vocabulary:
    """One per process. Without a path, the file of this machine's tokenizer folder."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(FILE)
    return Vocabulary(path)


def _lists(found: list[bytes]) -> pa.Array:
    values = np.frombuffer(b"".join(found), dtype=np.int32)
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _encode(path: str | None, text: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for batch in source:
            done, found, size = 0, [], 0
            for at, value in enumerate(batch.column(text)):
                raw = value.as_buffer()
                found.append(vocabulary.encode(raw.to_pybytes().decode("utf-8", "replace") if raw is not None else ""))
                size += len(found[-1]) // 4
                if size >= IDS_IN_BATCH or at == batch.num_rows - 1:
                    kept = [c.slice(done, len(found)) for k, c in enumerate(batch.columns) if k != text]
                    yield pa.RecordBatch.from_arrays([*kept, _lists(found)], names=[*(batch.schema.names[:text]), "ids"])
                    done, found, size = at + 1, [], 0

    return run


def encode(df: DataFrame, key: str, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, ids array<int>) of every row; ``vocabulary`` is the path of a byte-level BPE file on the executors."""
    rows = df.select(F.col(key), text_of(text).cast("binary").alias("__text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(_encode(vocabulary, 1), f"`{key}` {kind}, ids array<int>")


def _decode(path: str | None):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for batch in source:
            ids = batch.column(batch.schema.get_field_index("ids"))
            done, found, size = 0, [], 0
            for at, value in enumerate(ids):
                found.append(vocabulary.decode(value.values.to_numpy(zero_copy_only=False).tolist()) if value.is_valid else None)
                size += len(value.values) if value.is_valid else 0
                if size >= IDS_IN_BATCH or at == batch.num_rows - 1:
                    kept = [c.slice(done, len(found)) for c in batch.columns]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string())], names=[*batch.schema.names, "decoded"])
                    done, found, size = at + 1, [], 0

    return run


def decode(df: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The rows with ``decoded``, the text of their ``ids``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(_decode(vocabulary), f"{schema}, decoded string")


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids of every text and of what they decode to."""
    coded = decode(encode(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text", vocabulary), vocabulary)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
