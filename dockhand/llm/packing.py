"""Mixture-controlled packing by deficit round-robin.

Documents are dealt to shards by a hash, so every shard has every source and a
hot source is spread over all of them. In a shard each source is a queue of
documents. Every window gives each source its share of the window as quantum
on top of its deficit (what it was promised and has not yet had); sources are
served in turn from their queues, cutting documents where the quantum ends,
and what an empty queue cannot give is shared by the others. Deficits are
carried from window to window, and from shard to shard: a shard starts with
the difference between what the earlier shards owed each source and what they
had. Full windows are emitted as they fill; the rest of a shard is cut into
sequences whose lengths are powers of two, so there is no padding.

Defined results: a null text has no ids but its end; documents of a null
source form one queue; rows that repeat a ``doc_id`` are packed each, in the order of their ids; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.common import arrow, batches, cut, text_of, written
from dockhand.llm.subwords import CACHED_WORDS, default_vocabulary, forget, shared_ids

WINDOW = 2048
END_ID = 1
SHARD_BYTES = 8 << 20

TOKENS = arrow("doc_id long,source string,shard int,n long,ids binary")
PIECES = arrow("doc_id long,start long,length long,ids_crc32 long,doc_tokens long,sequence_id long,offset long")


def _tokenise(vocabulary: str):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = shared_ids(vocabulary, CACHED_WORDS), np.array([END_ID], dtype=np.uint16).tobytes()
        for batch in source:
            texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
            ids = [x.tobytes() + end for x in tokenizer.ids(texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("source"), batch.column("shard"),
                    pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                ],
                schema=TOKENS,
            )

    return run


class Shard:
    """Source queues of one shard and the deficit round-robin over them."""

    def __init__(self, number: int, shares: dict[str | None, float], deficits: dict[str | None, float]):
        self.number, self.shares, self.deficits = number, shares, deficits
        self.queues: dict[str | None, deque] = {}
        self.left = 0

    def add(self, source: str | None, doc_id: int | None, ids: np.ndarray) -> None:
        self.queues.setdefault(source, deque()).append([doc_id, ids, 0])
        self.left += len(ids)

    def _take(self, source: str | None, room: int) -> Iterator[tuple]:
        """Pieces of at most ``room`` ids from the head of a queue."""
        queue = self.queues[source]
        while room and queue:
            head = queue[0]
            doc_id, ids, at = head
            n = min(room, len(ids) - at)
            piece = ids[at : at + n].astype("<u4").tobytes()
            yield doc_id, at, n, zlib.crc32(piece), len(ids)
            room -= n
            if at + n == len(ids):
                queue.popleft()
            else:
                head[2] = at + n

    def fill(self, length: int) -> list[tuple]:
        """Pieces (doc_id, start, length, crc32, doc_tokens) of one sequence of ``length`` ids."""
        room, pieces = length, []
        for source, share in self.shares.items():
            self.deficits[source] = self.deficits.get(source, 0.0) + share * length
        # the most owed first, so that what is left by rounding goes to them
        turn = sorted((s for s, q in self.queues.items() if q), key=lambda s: (-self.deficits.get(s, 0.0), s is None, s or ""))
        for rest in (False, True):  # a second round for what empty queues could not give
            for source in turn:
                if not room:
                    break
                most = room if rest else min(room, int(max(self.deficits.get(source, 0.0), 0.0)))
                for piece in self._take(source, most):
                    pieces.append(piece)
                    room -= piece[2]
                    self.deficits[source] = self.deficits.get(source, 0.0) - piece[2]
        self.left -= length - room
        return pieces

    def sequences(self, window: int = WINDOW) -> Iterator[tuple[int, list[tuple]]]:
        """(sequence number in the shard, pieces): full windows, then powers of two."""
        number = 0
        while self.left:
            yield number, self.fill(window if self.left >= window else 1 << (self.left.bit_length() - 1))
            number += 1


def _pack(window: int):
    def flush(shard: Shard) -> Iterator[tuple]:
        for number, pieces in shard.sequences(window):
            offset = 0
            for doc_id, start, n, crc, tokens in pieces:
                yield doc_id, start, n, crc, tokens, (shard.number << 32) + number, offset
                offset += n

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared_ids.cache_info().currsize:
            forget()  # these tasks have no use for the words of the stage before
        shard, rows = None, []
        for batch in source:
            names = ("shard", "source", "doc_id", "ids", "share", "deficit", "head")
            for number, origin, doc_id, ids, share, deficit, head in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if shard is None or shard.number != number:
                    if shard is not None:
                        for row in flush(shard):
                            rows.append(row)
                            if len(rows) == 50_000:
                                yield from batches(rows, PIECES)
                                rows = []
                    shard = Shard(number, {}, {})
                if head:
                    shard.shares[origin], shard.deficits[origin] = share, deficit
                else:
                    shard.add(origin, doc_id, np.frombuffer(ids, dtype=np.uint16))
        if shard is not None:
            rows += flush(shard)
        yield from batches(rows, PIECES)

    return run


def tokenised(docs: DataFrame, vocabulary: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, source, shard, n, ids (uint16) of every document."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text_of("text").alias("text")
    )
    total = rows.agg(F.sum(F.octet_length("text").cast("long")), F.count(F.lit(1))).first()
    n = max(1, -(-((total[0] or 0) + 64 * total[1]) // shard_bytes))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("shard")
    return rows.select("doc_id", "source", shard, F.col("text").cast("binary").alias("text")).mapInArrow(
        _tokenise(vocabulary), "doc_id long, source string, shard int, n long, ids binary"
    )


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    targets: DataFrame | None = None,
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``targets`` (source, share) holds the token proportions of a window; by
    default the sources' shares of all tokens, which keeps every window like the corpus to the end.
    """
    tokens = written(tokenised(docs, vocabulary or default_vocabulary(), shard_bytes))
    counts = cut(tokens.groupBy("shard", "source").agg(F.sum("n").alias("n")))
    if targets is None:
        of_source = counts.groupBy("source").agg(F.sum("n").alias("n"))
    else:
        of_source = targets.select(F.col("source").cast("string").alias("source"), F.col("share").alias("n"))
    total = of_source.agg(F.sum("n")).first()[0] or 1
    shares = of_source.select("source", (F.col("n") / F.lit(total)).alias("share"))
    # what earlier shards held of a source, and in all: running sums over small tables of counts
    earlier = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("shard").agg(F.sum("n").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("past"))
    had = counts.select("shard", "source", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("had")).join(sizes, "shard")
    heads = had.alias("c").join(shares.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")), "left")
    share = F.coalesce("s.share", F.lit(0.0))
    heads = heads.select("c.shard", "c.source", share.alias("share"), (share * F.col("past") - F.col("had")).alias("deficit"))
    empty = F.lit(None)
    heads = heads.select(
        "shard", F.lit(True).alias("head"), "source", empty.cast("long").alias("doc_id"), empty.cast("binary").alias("ids"), "share", "deficit"
    )
    queued = tokens.select(
        "shard", F.lit(False).alias("head"), "source", "doc_id", "ids", empty.cast("double").alias("share"), empty.cast("double").alias("deficit")
    )
    dealt = heads.unionByName(queued).repartition("shard").sortWithinPartitions("shard", F.desc("head"), "source", "doc_id", "ids")
    return dealt.mapInArrow(
        _pack(window),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
