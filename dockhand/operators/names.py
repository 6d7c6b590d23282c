"""Names of several words found in texts: leftmost, then longest, without overlap.

A list of proven size is sent to the tasks, which build a trie of its words once
per process and walk every text through it; texts are not shuffled. A longer
list stays a table: runs of words, of the lengths that names have, meet it in an
equi join in which a run matches one name at most, so no first word fans out. A
filter of fixed size with a bit for every name's hash keeps most other runs from
leaving their text; what it lets through by chance finds no name in the join.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.functions.text import tokens
from dockhand.session import ensure_checkpoint_dir

MOST_NAMES_SENT = 100_000
MOST_CHARS_SENT = 8_000_000
FILTER_BITS, SEGMENT_BITS = 27, 19  # of the filter of a longer list, and of one row of it

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_END = ""  # no word is empty, so it marks the end of a name

Trie = dict


def normal_names(names: DataFrame) -> DataFrame:
    """(name, label, length): names as lower-case words joined by blanks, each once with its smallest label.

    Names without a letter and rows without a name or a label are left out.
    """
    words = names.select(tokens(F.col("name")).alias("words"), "label").filter("size(words) > 0 AND label IS NOT NULL")
    name = F.array_join("words", " ").alias("name")
    return words.groupBy(name, F.size("words").alias("length")).agg(F.min("label").alias("label")).select("name", "label", "length")


def build_trie(names: Iterable[tuple[str, str]]) -> Trie:
    """Nested maps from word to the rest of the names; the end of a name holds (name, label)."""
    trie: Trie = {}
    for name, label in names:
        node = trie
        for word in name.split(" "):
            node = node.setdefault(word, {})
        node[_END] = (name, label)
    return trie


def walk(trie: Trie, words: list[str]) -> Iterator[tuple[str, str]]:
    """Names in the words, left to right, the longest one at each place."""
    at = 0
    while at < len(words):
        node, found, end = trie.get(words[at]), None, at + 1
        after = end
        while node is not None:
            if _END in node:
                found, after = node[_END], end
            if end == len(words):
                break
            node = node.get(words[end])
            end += 1
        if found is not None:
            yield found
        at = after


@functools.lru_cache(maxsize=2)
def _trie_of(sent: Broadcast) -> Trie:
    return build_trie(sent.value)


def _walked(source: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    trie = _trie_of(sent)
    for batch in source:
        rows: list[int] = []
        found: list[tuple[str, str]] = []
        times: list[int] = []
        for row, words in enumerate(batch.column("words")):
            for name, n in Counter(walk(trie, words.as_py() or [])).items():
                rows.append(row)
                found.append(name)
                times.append(n)
        if rows:
            name, label = zip(*found, strict=True)
            columns = [batch.column("key").take(pa.array(rows)), pa.array(name), pa.array(label), pa.array(times, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "name", "label", "n"])


def _word_hash(word: Column) -> Column:
    return F.xxhash64(word)


def _run_positions(hashes: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """For runs of 1 to ``longest`` words, the place in the filter of the run that starts at each word; ends are not looked at."""
    run = hashes
    for n in range(1, longest + 1):
        if n > 1:
            run = run[:-1] * _STEP + hashes[n - 1 :]
        mixed = (run ^ (run >> np.uint64(32))) * _MIX + np.uint64(n)
        yield (mixed ^ (mixed >> np.uint64(29))) * _STEP >> np.uint64(64 - FILTER_BITS)


def _flat(column: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The entries of all lists, and where each list ends among them."""
    ends = column.offsets.to_numpy()
    return column.values.slice(ends[0], ends[-1] - ends[0]), ends[1:] - ends[0]


def _name_positions(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        hashes, ends = _flat(batch.column("hashes"))
        hashes, sizes = hashes.to_numpy().view(np.uint64), np.diff(ends, prepend=0)
        found = [np.zeros(0, dtype=np.uint64)]
        for n, at in enumerate(_run_positions(hashes, int(sizes.max(initial=0))), 1):
            found.append(at[ends[sizes == n] - n])
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).astype(np.int64))], names=["place"])


def _segment(key: tuple, places: pa.Table) -> pa.Table:
    bits = np.zeros(1 << SEGMENT_BITS, dtype=bool)
    bits[places.column("place").to_numpy() & ((1 << SEGMENT_BITS) - 1)] = True
    return pa.table({"segment": [key[0].as_py()], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def _filter_of(names: DataFrame) -> np.ndarray:
    """A bit for the hash of every name, 16 MB for any list."""
    words = names.select(F.transform(F.split("name", " "), _word_hash).alias("hashes"))
    places = words.mapInArrow(_name_positions, "place long").distinct()
    segments = places.groupBy(F.shiftright("place", SEGMENT_BITS).alias("segment")).applyInArrow(_segment, "segment long, bits binary")
    bits = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    size = 1 << (SEGMENT_BITS - 3)
    for row in segments.toLocalIterator():
        bits[row.segment * size : (row.segment + 1) * size] = np.frombuffer(row.bits, dtype=np.uint8)
    return bits


def _runs(source: Iterator[pa.RecordBatch], sent: Broadcast, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """(row, key, start, name) of the runs of words that pass the filter; few others do."""
    bits = sent.value
    for batch in source:
        words, ends = _flat(batch.column("words"))
        hashes, _ = _flat(batch.column("hashes"))
        if not len(words):
            continue
        row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        left = ends[row] - np.arange(len(row))  # words from each one to the end of its text
        first = np.diff(ends, prepend=0)[row] - left
        for n, at in enumerate(_run_positions(hashes.to_numpy().view(np.uint64), min(max(lengths), int(left.max()))), 1):
            if n not in lengths:
                continue
            hit = np.flatnonzero((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1)
            hit = hit[left[hit] >= n]
            for some in np.array_split(hit, len(hit) // 100_000 + 1):
                name = pc.binary_join_element_wise(*(words.take(pa.array(some + i)) for i in range(n)), " ") if n > 1 else words.take(pa.array(some))
                of = pa.array(row[some])
                columns = [batch.column("row").take(of), batch.column("key").take(of), pa.array(first[some], pa.int32()), name]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "key", "start", "name"])


def _kept(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names in each text without overlap; the names of a text come one after another, by start, the longest first."""
    row, key, end, counts = None, None, 0, Counter()
    for batch in source:
        schema = pa.schema([batch.schema.field("key"), ("name", pa.string()), ("label", pa.string()), ("n", pa.int64())])
        out: list[tuple] = []
        keys = batch.column("key")
        columns = (batch.column(c).to_pylist() for c in ("row", "start", "length", "name", "label"))
        for i, (of, start, length, name, label) in enumerate(zip(*columns, strict=True)):
            if of != row:
                out += [(key, *found, n) for found, n in counts.items()]
                row, key, end, counts = of, keys[i].as_py(), 0, Counter()
            if start >= end:
                counts[name, label] += 1
                end = start + length
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    if counts:
        out = [(key, *found, n) for found, n in counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _joined(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(key, name, label, n) by a join of word runs; of the runs, those leave their text that pass a filter of the names."""
    lengths = [r.length for r in names.select("length").distinct().collect()]  # a few small numbers
    schema = f"key {texts.schema['key'].dataType.simpleString()}, name string, label string, n long"
    if not lengths:
        return texts.sparkSession.createDataFrame([], schema)
    sent = texts.sparkSession.sparkContext.broadcast(_filter_of(names))
    placed = texts.withColumn("row", F.monotonically_increasing_id()).select("row", "key", "words", F.transform("words", _word_hash).alias("hashes"))
    of_key = texts.schema["key"].dataType.simpleString()
    runs = placed.mapInArrow(functools.partial(_runs, sent=sent, lengths=lengths), f"row long, key {of_key}, start int, name string")
    met = runs.join(names, "name").select("row", "key", "start", "length", "name", "label")
    return met.repartition("row").sortWithinPartitions("row", "start", F.desc("length")).mapInArrow(_kept, schema)


def name_entities(
    df: DataFrame,
    names: DataFrame,
    key: str,
    text: str = "text",
    most_names: int = MOST_NAMES_SENT,
    most_chars: int = MOST_CHARS_SENT,
) -> DataFrame:
    """Rows (key, name, label, n): how often each name stands in each text.

    ``names`` has a ``name`` of one or more words and a ``label``. Words are lower-case runs of letters, whatever
    stands between them. Rows that share a key give rows of their own; null and empty texts give none.
    Runs jobs when called: the list is measured before it is sent.
    """
    ensure_checkpoint_dir(df.sparkSession)
    names = normal_names(names).checkpoint()  # its source is read once
    texts = df.select(F.col(key).alias("key"), tokens(F.col(text)).alias("words"))
    size = names.agg(F.count(F.lit(1)).alias("held"), F.sum(F.length("name") + F.length("label")).alias("chars")).first()
    if size.held <= most_names and (size.chars or 0) <= most_chars:
        sent = df.sparkSession.sparkContext.broadcast([(r.name, r.label) for r in names.select("name", "label").collect()])
        schema = f"key {texts.schema['key'].dataType.simpleString()}, name string, label string, n long"
        found = texts.mapInArrow(functools.partial(_walked, sent=sent), schema)
    else:
        found = _joined(texts, names)
    return found.withColumnRenamed("key", key)
