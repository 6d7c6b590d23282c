"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix takes as many words as the table has. Sources share them by weight,
but no target exceeds ``MOST`` times its source; what is above is shared again
by weight. Word streams of (source, shard) are cut into blocks of equal
numbers of words; the blocks of the mix are apportioned to sources, and those
of a source to its shards, by highest quotients votes / (2 seats + 1). Each
shard then takes every block quota // blocks times and a seeded choice of them
once more. A hot source has more shards; a shard holds a bounded number of
words and documents.

Defined results: a null text has size 0; documents of size 0 are returned
with ``taken`` 0; a null source is a source of its own, the last one; a table
without any words has targets 0; rows that repeat a ``doc_id`` are documents
of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.common import WORD, arrow, batches, cut, text_of

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 32
SHARD_WORDS = 1_000_000
SHARD_ROWS = 20_000
SEED = 7


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by highest quotients votes / (2 s + 1), ties to the earlier entry; no entry gets more than ``most``.

    The divisor is found by bisection, so the work does not grow with the
    number of seats; only seats whose quotients lie at the divisor are dealt
    out one by one.
    """
    votes, most = votes.astype(np.float64), np.where(votes > 0, most, 0).astype(np.int64)
    seats = min(int(seats), int(most.sum()))

    def dealt(divisor: float) -> np.ndarray:
        """Seats whose quotient is above the divisor."""
        return np.clip(np.ceil((votes / divisor - 1) / 2), 0, most).astype(np.int64)

    if seats <= 0:
        return np.zeros(len(votes), dtype=np.int64)
    low, high = 0.0, float(votes.max()) * 2
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if dealt(middle).sum() <= seats:
            high = middle
        else:
            low = middle
    given = dealt(high * (1 + 1e-9))  # above all quotients that tie at the divisor
    while given.sum() < seats:
        quotients = np.where(given < most, votes / (2 * given + 1), -1.0)
        given[int(np.argmax(quotients))] += 1
    return given


def shares(sizes: np.ndarray, weights: np.ndarray, total: float, most: int = MOST) -> np.ndarray:
    """Weighted shares of ``total``, none above ``most * size``; the excess goes to the others by weight."""
    caps, targets = sizes * float(most), np.zeros(len(sizes))
    full = sizes <= 0
    while not full.all():
        left = total - caps[full].sum()
        targets = np.where(full, caps, weights * left / weights[~full].sum())
        above = ~full & (targets > caps)
        if not above.any():
            break
        full |= above
    return np.where(full, caps, targets)


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, n_rows of a (source, size) table; one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))

    def share(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the list of sources is a setting of the mix and lies in one task
        parts = list(parts)
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        keys = [(s is None, s.encode() if s is not None else b"") for s in rows["source"]]
        rows = rows.iloc[sorted(range(len(keys)), key=keys.__getitem__)].reset_index(drop=True)
        weights = np.array([WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))], dtype=np.float64)
        words = rows["source_size"].to_numpy(dtype=np.float64)
        rows["target"] = shares(words, weights, words.sum())
        yield rows

    return per.coalesce(1).mapInPandas(share, "source string, source_size long, n_rows long, target double")


QUOTAS = "source string, shard int, quota long"


def _quotas(targets: DataFrame, shards: DataFrame, block: int) -> DataFrame:
    """Blocks each (source, shard) has to give."""

    def by_source(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(parts)
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        blocks, targets = rows["blocks"].to_numpy(dtype=np.int64), rows["target"].to_numpy(dtype=np.float64)
        full = targets >= MOST * rows["source_size"].to_numpy(dtype=np.float64)
        seats = np.where(full, MOST * blocks, 0)
        left = round(targets[~full].sum() / block)
        seats += sainte_lague(np.where(full, 0, targets), left, np.where(full, 0, MOST * blocks))
        yield rows.assign(seats=seats)[["source", "seats"]]

    def by_shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard", ignore_index=True)
        blocks = rows["blocks"].to_numpy(dtype=np.int64)
        quota = sainte_lague(rows["words"].to_numpy(dtype=np.float64), int(rows["seats"].iloc[0]), MOST * blocks)
        return rows.assign(quota=quota)[["source", "shard", "quota"]]

    of_source = shards.groupBy("source").agg(F.sum("blocks").alias("blocks"))
    same = F.col("t.source").eqNullSafe(F.col("b.source"))
    joined = targets.alias("t").join(of_source.alias("b"), same).select("t.source", "t.source_size", "t.target", "b.blocks")
    seats = joined.coalesce(1).mapInPandas(by_source, "source string, seats long")
    same = F.col("h.source").eqNullSafe(F.col("s.source"))
    dealt = shards.alias("h").join(seats.alias("s"), same).select("h.*", "s.seats")
    return dealt.groupBy("source").applyInPandas(by_shard, QUOTAS)


def block_times(words: int, quota: int, block: int, seed: tuple[int, ...]) -> np.ndarray:
    """How often each block of a shard's word stream is taken."""
    n = -(-words // block)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    times = np.full(n, quota // n, dtype=np.int64)
    times[np.random.default_rng(seed).permutation(n)[: quota % n]] += 1
    return times


def taken_words(sizes: np.ndarray, times: np.ndarray, block: int) -> np.ndarray:
    """Words taken of each document, documents standing one after another in the stream."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    before = np.concatenate([[0], np.cumsum(times)]) * block
    at = np.minimum(ends // block, len(times))
    inside = np.where(at < len(times), times[np.minimum(at, max(len(times) - 1, 0))] if len(times) else 0, 0)
    return np.diff(before[at] + (ends - at * block) * inside)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, hash of the text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text_of("text"), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text_of("text")).alias("hash"),
    )


def mixture(docs: DataFrame, block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken, start (in its shard), shard, quota, words of the shard."""
    sizes = cut(sized(docs))
    targets = cut(source_targets(sizes))
    n = F.ceil(F.greatest(F.col("source_size") / shard_words, F.col("n_rows") / SHARD_ROWS, F.lit(1))).cast("int")
    # sources are few; the join is by measured size, and a hot source on the side of the documents may be split
    rows = sizes.alias("d").join(targets.withColumn("n", n).alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    rows = rows.select("d.*", "t.source_size", "t.target", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("n")).cast("int").alias("shard"))
    shards = rows.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    shards = shards.withColumn("blocks", F.ceil(F.col("words") / block).cast("long"))
    quotas = _quotas(targets, shards, block)
    same = F.col("r.source").eqNullSafe(F.col("q.source")) & (F.col("r.shard") == F.col("q.shard"))
    dealt = rows.alias("r").join(quotas.alias("q"), same).select("r.*", "q.quota")

    def take(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "size", "hash"], ignore_index=True)
        source, shard, quota = part["source"].iloc[0], int(part["shard"].iloc[0]), int(part["quota"].iloc[0])
        words = part["size"].to_numpy(dtype=np.int64)
        times = block_times(int(words.sum()), quota, block, (seed, shard, *(source or "").encode()))
        starts = np.concatenate([[0], np.cumsum(words)])[:-1]
        return part.assign(taken=taken_words(words, times, block), start=starts, words=int(words.sum()))

    return dealt.groupBy("source", "shard").applyInPandas(
        take,
        "doc_id long, source string, size long, hash long, source_size long, target double, shard int, quota long, "
        "taken long, start long, words long",
    )


COPIES = arrow("doc_id long,text string,lang string,source string,n_chars long")


def mixed_documents(docs: DataFrame, block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """The mix itself: for every pass over a document, one row with the words taken in it.

    A pass that takes all words returns the text as it is; one that takes some
    returns the pieces of the text under the taken blocks, in order, joined by line breaks.
    """
    import re

    plan = mixture(docs, block, shard_words, seed).filter("taken > 0")
    plan = plan.select(F.col("doc_id").alias("own_id"), "size", "hash", "shard", "quota", "start", "words", F.col("source").alias("own_source"))
    plan = plan.dropDuplicates(["own_id", "own_source", "hash"])  # rows that are equal in these take the same words
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("own_id")) & F.col("source").cast("string").eqNullSafe(F.col("own_source"))
    rows = rows.join(plan, same & (F.xxhash64(text_of("text")) == F.col("hash"))).drop("own_id", "hash")
    word = re.compile(WORD.encode())

    def cut_out(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, np.ndarray] = {}
        for batch in source:
            out = []
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            for i, text in enumerate(columns["text"]):
                g = {name: values[i] for name, values in columns.items()}
                key = (g["own_source"], g["shard"])
                if key not in kept:
                    if len(kept) > 64:
                        kept.clear()
                    kept[key] = block_times(g["words"], g["quota"], block, (seed, g["shard"], *(g["own_source"] or "").encode()))
                first = g["start"] // block
                times = kept[key][first : (g["start"] + g["size"] - 1) // block + 1]
                raw, spans = text.encode(), None
                for turn in range(1, int(times.max()) + 1):
                    on = times >= turn
                    if on.all():
                        piece = text
                    else:
                        spans = spans or [m.span() for m in word.finditer(raw)]
                        edges = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
                        pieces = []
                        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                            start = max((first + a) * block - g["start"], 0)
                            end = min((first + b) * block - g["start"], g["size"])
                            pieces.append(raw[spans[start][0] : spans[end - 1][1]])
                        piece = b"\n".join(pieces).decode()
                    out.append((g["doc_id"], piece, g["lang"], g["source"], len(piece)))
            yield from batches(out, COPIES)

    return rows.mapInArrow(cut_out, "doc_id long, text string, lang string, source string, n_chars long")
