"""Exact dedup by Patricia-trie owners.

Whole normalised texts are inserted as byte strings into compressed radix
tries. A terminal node stands for one text and keeps the smallest identifier
and the number of rows. Every task first collapses its own rows (so a text
that fills a third of the table leaves a task as one row), then texts meet in
partitions by length and content hash, where a second trie finds the owner. A
trie over its memory budget writes its heaviest subtree to a task-local file
and finishes it afterwards as a trie of its own.

Defined results: a null text counts as empty; empty texts are equal to each
other; rows that repeat a ``doc_id`` count in ``group_size`` and share one
fate; a null ``doc_id`` never owns a text unless all its rows have none
(``keep_id`` is then null and nothing of the group is kept); an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.common import arrow, batches, text_of

TRIE_BYTES = 48 << 20
NODE_BYTES = 250
OUT_BYTES = 8 << 20


def _shared(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key[at:]``."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == key[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    __slots__ = ("label", "children", "rows", "owner", "spilled")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.rows = 0
        self.owner: int | None = None
        self.spilled = None


class OwnerTrie:
    """Compressed radix trie over byte strings with (smallest identifier, rows) at terminals."""

    def __init__(self, budget: int = TRIE_BYTES, spill: bool = True):
        self.budget, self.spill = budget, spill
        self.root, self.size, self.spills = Node(b""), 0, 0

    @property
    def full(self) -> bool:
        return self.size > self.budget

    def insert(self, key: bytes, owner: int | None, rows: int = 1) -> None:
        node, at = self.root, 0
        while True:
            if node.spilled is not None:
                pickle.dump((key, owner, rows), node.spilled, protocol=5)
                return
            if at == len(key):
                node.rows += rows
                if node.owner is None or (owner is not None and owner < node.owner):
                    node.owner = owner
                break
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.size += len(key) - at + NODE_BYTES
                node, at = child, len(key)
                continue
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            cut = _shared(child.label, key, at)
            middle = Node(child.label[:cut])
            child.label = child.label[cut:]
            middle.children[child.label[0]] = child
            node.children[key[at]] = middle
            self.size += NODE_BYTES
            node, at = middle, at + cut
        if self.spill and self.full:
            self._spill_heaviest()

    def _terminals(self, top: Node, path: bytes) -> Iterator[tuple[bytes, Node]]:
        stack = [(top, path)]
        while stack:
            node, above = stack.pop()
            key = above + node.label
            if node.rows or node.spilled is not None:
                yield key, node
            stack.extend((child, key) for child in node.children.values())

    @staticmethod
    def _weight(top: Node) -> int:
        total, stack = 0, [top]
        while stack:
            node = stack.pop()
            total += len(node.label) + NODE_BYTES
            stack.extend(node.children.values())
        return total

    def _spill_heaviest(self) -> None:
        """Write the heaviest subtree below the first branching to a file."""
        path, node = b"", self.root
        while len(node.children) == 1 and not node.rows:
            path, node = path + node.label, next(iter(node.children.values()))
        heavy = max((c for c in node.children.values() if c.spilled is None), key=self._weight, default=None)
        if heavy is None or not node.children:
            return  # one text alone cannot be divided
        file = tempfile.TemporaryFile()  # noqa: SIM115  closed when it has been read back
        for key, end in self._terminals(heavy, path + node.label):
            if end.spilled is not None:  # spilled before a node came above it
                end.spilled.seek(0)
                shutil.copyfileobj(end.spilled, file)
                end.spilled.close()
            else:
                pickle.dump((key, end.owner, end.rows), file, protocol=5)
        self.size -= self._weight(heavy)
        heavy.children, heavy.rows, heavy.spilled = {}, 0, file
        self.spills += 1

    def owners(self) -> Iterator[tuple[bytes, int | None, int]]:
        """(text, smallest identifier, rows) of every terminal, spilled subtrees last."""
        later = []
        for key, node in self._terminals(self.root, b""):
            if node.spilled is not None:
                later.append(node.spilled)
            else:
                yield key, node.owner, node.rows
        self.root = Node(b"")
        for file in later:
            file.seek(0)
            inner = OwnerTrie(self.budget, self.spill)
            try:
                while True:
                    inner.insert(*pickle.load(file))  # noqa: S301  written by this task
            except EOFError:
                file.close()
            yield from inner.owners()


LOCAL = arrow("n_bytes long,digest string,text binary,owner long,n long")
OWNERS = arrow("n_bytes long,digest string,keep_id long,group_size long")


def _emit(rows: Iterator[tuple], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size > OUT_BYTES or len(held) >= 20_000:
            yield from batches(held, schema)
            held, size = [], 0
    yield from batches(held, schema)


def _collapse(budget: int):
    """Task-local tries: one row per text, emptied whenever the budget is reached."""

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = OwnerTrie(budget, spill=False)

        def drain() -> Iterator[tuple]:
            for text, owner, n in trie.owners():
                yield len(text), hashlib.sha256(text).hexdigest(), text, owner, n

        for batch in source:
            for text, doc in zip(batch.column("text"), batch.column("doc_id").to_pylist(), strict=True):
                trie.insert(text.as_buffer().to_pybytes(), doc)
                if trie.full:
                    yield from drain()
                    trie = OwnerTrie(budget, spill=False)
        yield from drain()

    return lambda source: _emit(rows(source), LOCAL, lambda row: len(row[2]))


def _own(budget: int):
    """The trie of one length-and-hash partition."""

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = OwnerTrie(budget)
        for batch in source:
            for text, owner, n in zip(
                batch.column("text"), batch.column("owner").to_pylist(), batch.column("n").to_pylist(), strict=True
            ):
                trie.insert(text.as_buffer().to_pybytes(), owner, n)
        for text, owner, n in trie.owners():
            yield len(text), hashlib.sha256(text).hexdigest(), owner, n

    return lambda source: _emit(rows(source), OWNERS, lambda row: 100)


def normalised(docs: DataFrame, text: str = "text") -> F.Column:
    """The text with every run of ASCII white space as one space; single spaces are left alone."""
    return F.regexp_replace(text_of(text), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def text_owners(docs: DataFrame, budget: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: n_bytes, digest, keep_id, group_size."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(docs).cast("binary").alias("text"))
    local = rows.mapInArrow(_collapse(budget), "n_bytes long, digest string, text binary, owner long, n long")
    dealt = local.repartition("n_bytes", "digest")
    return dealt.mapInArrow(_own(budget), "n_bytes long, digest string, keep_id long, group_size long")


def exact_groups(docs: DataFrame, budget: int = TRIE_BYTES) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    The rows of a text find its terminal again by byte length and SHA-256 of
    the text; copies of a hot text are on the side AQE may split.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(docs).cast("binary").alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("digest"))
    found = rows.join(text_owners(docs, budget), ["n_bytes", "digest"])
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, budget: int = TRIE_BYTES) -> DataFrame:
    """One row of every text, with all columns: the row that owns it.

    A text owned by an id is kept under that id, whatever else the id names; a text
    without any id is kept too. Of rows with one id and text, the first by their other columns stays.
    """
    key = ["__bytes", "__digest"]
    raw = normalised(docs).cast("binary")
    rows = docs.withColumns({"__bytes": F.octet_length(raw).cast("long"), "__digest": F.sha2(raw, 256)})
    owners = text_owners(docs, budget).select(F.col("n_bytes").alias("__bytes"), F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep"))
    owned = rows.join(owners, key).filter(F.col("doc_id").cast("long").eqNullSafe(F.col("__keep")))
    order = Window.partitionBy(*key).orderBy(*(F.col(c).cast("string") for c in ("lang", "source", "n_chars", "text") if c in docs.columns))
    return owned.withColumn("__place", F.row_number().over(order)).filter("__place = 1").select(*docs.columns)
