"""A stored index of posting blocks: ranked search that skips blocks, phrases, facets.

Documents are numbered by their key, and a block holds the postings of one
term for the documents of one range of ``width`` keys, so a block is bounded
whatever the term. A row of the index is

    term, block, n (documents), max_tf, offsets (keys within the block),
    tfs, positions (places of the term in each document)

and the rows are stored in order of (term, block), ranges over both, so a
common term spans many files. ``n`` and ``max_tf`` are what a search reads
first: they give each term's weight and for every block the best score that a
document in it can have. The lists are read of those blocks only whose bound
reaches the k-th best score found in the most promising ones.

A task puts the words of the documents that it reads in order and sends one row
for each of their terms and blocks, so a block whose documents lie together comes
from few rows.

Keys are longs, one row each; rows without a key are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.functions.text import tokens

WIDTH = 1024
FIRST_BLOCKS = 16  # blocks of the best bounds, which give the score to beat
MOST_BLOCKS_NAMED = 2_000  # of blocks to read; more are joined instead of named in the filter
ROUNDING = 1e-6

GROUP_WORDS = 2_000_000  # words that a task puts in order at a time

INTS = pa.list_(pa.int32())
PARTS = pa.schema([("term", pa.string()), ("block", pa.int64()), ("offsets", INTS), ("ends", INTS), ("places", INTS)])
PARTS_SQL = "term string, block long, offsets array<int>, ends array<int>, places array<int>"


def _lists(starts: np.ndarray, size: int, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, size).astype(np.int32)), pa.array(values.astype(np.int32)))


def _parts_of(keys: np.ndarray, words: pa.Array, ends: np.ndarray, width: int) -> pa.RecordBatch:
    """Parts of blocks: the rows' words in order of (term, block, offset, place). Rows that share a key stay apart."""
    sizes = np.diff(ends, prepend=0)
    coded = words.dictionary_encode()
    code, row = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(keys)), sizes)
    by_key = np.empty(len(keys), dtype=np.int64)
    by_key[np.argsort(keys, kind="stable")] = np.arange(len(keys))
    at = np.argsort(code * len(keys) + by_key[row], kind="stable")  # places of a row are in order already
    code, row = code[at], row[at]
    places = at - (ends - sizes)[row]
    entry = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (row[1:] != row[:-1])))
    block, offset = np.divmod(keys[row[entry]], width)
    term = code[entry]
    first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])))
    ends_at = np.append(entry[1:], len(at))  # of the places of each entry, here and from the start of its row
    ends_in = ends_at - np.repeat(entry[first], np.diff(np.append(first, len(entry))))
    lists = [_lists(first, len(entry), offset), _lists(first, len(entry), ends_in), _lists(entry[first], len(at), places)]
    terms = coded.dictionary.take(pa.array(term[first]))
    return pa.RecordBatch.from_arrays([terms, pa.array(block[first]), *lists], schema=PARTS)


def _parts(width: int):
    def parts(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            words, keys = batch.column("words"), batch.column("key").to_numpy()
            ends = words.offsets.to_numpy()
            start = 0
            while start < len(keys):  # whole rows, one at least
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + GROUP_WORDS, side="right")) - 1)
                if ends[stop] > ends[start]:
                    held = words.values.slice(ends[start], ends[stop] - ends[start])
                    yield _parts_of(keys[start:stop], held, ends[start + 1 : stop + 1] - ends[start], width)
                start = stop

    return parts


def block_parts(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Rows (term, block, offsets, ends, places): what the documents that a task reads together add to a block. No shuffle.

    ``places`` holds those of all offsets one after another, ``ends`` where each one's end; flat lists take the least room.
    """
    listed = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), tokens(F.col(text)).alias("words"))
    return listed.mapInArrow(_parts(width), PARTS_SQL)


def _entries() -> Column:
    """Structs (offset, tf, places) of a part."""

    def entry(offset: Column, at: Column) -> Column:
        start = F.when(at == 0, F.lit(0)).otherwise(F.get("ends", at - 1))
        tf = F.get("ends", at) - start
        return F.struct(offset.alias("offset"), tf.alias("tf"), F.slice("places", start + 1, tf).alias("places"))

    return F.transform("offsets", entry)


def placed_postings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (term, key, places) of every document and word, places from 0. No shuffle: a document is read in its row."""
    entries = block_parts(docs, key, text).select("term", "block", F.inline(_entries()))
    return entries.select("term", (F.col("block") * WIDTH + F.col("offset")).alias("key"), "places")


def blocks_of(parts: DataFrame) -> DataFrame:
    """The index rows, range partitioned and sorted by (term, block). One shuffle, for the order and the blocks."""
    dealt = parts.repartitionByRange("term", "block").select("term", "block", _entries().alias("entries"))
    entries = F.sort_array(F.flatten(F.collect_list("entries"))).alias("entries")  # at most ``width`` of a block
    grouped = dealt.groupBy("term", "block").agg(entries).sortWithinPartitions("term", "block")
    return grouped.select(
        "term",
        "block",
        F.size("entries").alias("n"),
        F.array_max("entries.tf").alias("max_tf"),
        F.col("entries.offset").alias("offsets"),
        F.col("entries.tf").alias("tfs"),
        F.col("entries.places").alias("positions"),
    )


def write_block_index(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> None:
    """Store the index of a table and its size. Runs jobs; texts are read once, the ranges are drawn from kept parts."""
    parts = block_parts(docs, key, text, width).persist(StorageLevel.DISK_ONLY)
    try:
        blocks_of(parts).write.mode("overwrite").parquet(f"{folder}/blocks")
    finally:
        parts.unpersist()
    size = docs.agg(F.count(F.lit(1)).alias("n_docs")).withColumn("width", F.lit(width).cast("long"))
    size.coalesce(1).write.mode("overwrite").parquet(f"{folder}/size")


def _back(places: int) -> Callable[[Column], Column]:
    return lambda place: place - places


class BlockIndex:
    """Searches on a stored index; nothing but the index is read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.blocks = spark.read.parquet(f"{folder}/blocks")
        self.n_docs, self.width = spark.read.parquet(f"{folder}/size").first()

    def of_terms(self, terms: list[str]) -> DataFrame:
        """Index rows of the words; the filter is pushed to the scan."""
        return self.blocks.filter(F.col("term").isin(sorted({t.lower() for t in terms})))

    def _key(self, offset: Column) -> Column:
        return F.col("block") * self.width + offset

    def bounds(self, terms: list[str]) -> DataFrame:
        """(block, bound): the best score a document of the block can have. Reads no lists."""
        rows = self.of_terms(terms).select("term", "block", "n", "max_tf")
        return rows.join(F.broadcast(self.weights(terms)), "term").groupBy("block").agg(F.sum(F.col("max_tf") * F.col("idf")).alias("bound"))

    def weights(self, terms: list[str]) -> DataFrame:
        """(term, idf), one row per query term."""
        df = F.sum("n")
        return self.of_terms(terms).groupBy("term").agg(F.log(F.lit(self.n_docs) / df).alias("idf"))

    def scores(self, terms: list[str], blocks: DataFrame | list[int] | None = None) -> DataFrame:
        """(key, score) of the documents that hold a word, in the given blocks: sum of tf * ln(N / df)."""
        rows = self.of_terms(terms)
        if isinstance(blocks, list):
            rows = rows.filter(F.col("block").isin(blocks))
        elif blocks is not None:
            rows = rows.join(blocks.select("block"), "block", "left_semi")
        hits = rows.select("term", "block", F.inline(F.arrays_zip("offsets", "tfs"))).join(F.broadcast(self.weights(terms)), "term")
        return hits.groupBy(self._key(F.col("offsets")).alias("key")).agg(F.round(F.sum(F.col("tfs") * F.col("idf")), 6).alias("score"))

    def blocks_to_read(self, terms: list[str], k: int) -> tuple[list[int], DataFrame]:
        """The blocks of the best bounds, and the other blocks that may hold one of the ``k`` best. Runs two jobs."""
        bounds = self.bounds(terms)
        first = [r["block"] for r in bounds.orderBy(F.desc("bound"), "block").limit(FIRST_BLOCKS).collect()]
        best = self.scores(terms, first).orderBy(F.desc("score")).limit(k).collect()
        others = bounds.filter(~F.col("block").isin(first))
        if len(best) == k:  # a lower bound than the k-th best score cannot get in; an equal one may, by its key
            others = others.filter(F.col("bound") + ROUNDING >= best[-1]["score"])
        return first, others.select("block")

    def search(self, terms: list[str], k: int, key: str = "doc_id") -> DataFrame:
        """The ``k`` best documents by the sum of tf * ln(N / df); ties by key. Runs jobs when called."""
        first, others = self.blocks_to_read(terms, k)
        named = [r["block"] for r in others.limit(MOST_BLOCKS_NAMED + 1).collect()]
        if len(named) <= MOST_BLOCKS_NAMED:
            scored = self.scores(terms, sorted({*first, *named}))
        else:
            scored = self.scores(terms, first).unionByName(self.scores(terms, others))
        return scored.orderBy(F.desc("score"), "key").limit(k).withColumnRenamed("key", key)

    def phrase(self, words: list[str], key: str = "doc_id") -> DataFrame:
        """(key, n): documents that hold the words one after another, and how often. Only blocks with all words are decoded."""
        words = [w.lower() for w in words]
        terms = sorted(set(words))
        rows = self.of_terms(terms)
        whole = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(terms))
        hits = (
            rows.join(whole.select("block"), "block", "left_semi")
            .select("term", "block", F.inline(F.arrays_zip("offsets", "positions")))
            .groupBy(self._key(F.col("offsets")).alias("key"))
            .agg(*(F.first(F.when(F.col("term") == t, F.col("positions")), ignorenulls=True).alias(f"p{i}") for i, t in enumerate(terms)))
        )
        starts = None
        for at, word in enumerate(words):
            moved = F.transform(f"p{terms.index(word)}", _back(at))
            starts = moved if starts is None else F.array_intersect(starts, moved)
        found = hits.select(F.col("key").alias(key), F.size(starts).cast("long").alias("n"))  # -1 where a word is missing
        return found.filter(F.col("n") > 0)

    def facets(self, docs: DataFrame, terms: list[str], facets: list[str], key: str = "doc_id") -> DataFrame:
        """Documents holding any of the words, counted by the facet columns; texts are not read."""
        hits = self.of_terms(terms).select("block", F.explode("offsets").alias("offset")).select(self._key(F.col("offset")).alias(key))
        return docs.join(hits.distinct(), key, "left_semi").groupBy(*facets).agg(F.count(F.lit(1)).alias("n_docs"))
