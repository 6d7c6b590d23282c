"""MinHash near-dedup with SetSketch registers.

Every document's set of word shingles becomes ``REGISTERS`` SetSketch registers:
register i is floor(1 - log_b(x)) of the smallest of exponentially distributed
hashes, cut off at 0 and 65535, so sketches of parts merge by maximum and
similar sets agree in many registers. Bands of registers name candidates; for
a candidate pair the likelihood of the joint register states gives the
Jaccard similarity, and pairs far less likely at the threshold are left out;
all others are confirmed on the full sets.

Documents with equal sets are one class, so copies never meet each other. A
bucket of classes is not turned into pairs: first every member is compared
with the smallest one; then only members that still lie in different
components meet, those outside the bucket's largest component against all,
in blocks of bounded size.
With the default bands a pair at similarity 0.8 is missed once in ten million.

A class of equal sets is a node with a number of its own, so texts that share a
``doc_id`` are apart and each meets its own near copies.

Defined results: a text without words (or null) has an empty set and is linked
with nothing; rows that repeat a ``doc_id`` are documents of their own and give a
row each, with the smallest ``doc_id`` of their own component; rows without a
``doc_id`` take no part, their component is null and they are not kept; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import arrow, batches, cut, text_of, written
from dockhand.llm.components import components
from dockhand.llm.shingles import WORDS_IN_SHINGLE, common, groups, mix, shingle_sets

BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
BASE, RATE = 1.001, 20.0
LEAST, OF = 80, 100  # linked at OF * common >= LEAST * union
UNLIKELY = 24.0  # twice the log-likelihood ratio beyond which a pair is not confirmed
LEAST_EQUAL = 120  # equal registers; at the threshold 160 are expected, with a deviation below 6
BLOCK, CHUNK, ROW_WEIGHT = 1 << 18, 1 << 18, 100  # in shingles
PARTNERS = 256
MOST_IDS_SENT = 1_000_000

_random = np.random.default_rng(4_711)
_FLIPS = _random.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_FACTORS = _random.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers of non-empty sets, (n, REGISTERS) uint16."""
    values = (np.concatenate(sets) >> np.uint64(16)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    least = np.empty((REGISTERS, len(sets)), dtype=np.uint32)
    for i in range(REGISTERS):
        hashed = (values ^ _FLIPS[i]) * _FACTORS[i]
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(2246822519)
        least[i] = np.minimum.reduceat(hashed, starts)
    smallest = -np.log1p(-(least.T + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, 65535).astype(np.uint16)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, (n, BANDS) int64."""
    parts = sketches.reshape(len(sketches), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for row in range(ROWS):
        keys = mix(keys * np.uint64(65599) + parts[:, :, row])
    return keys.astype(np.int64)


_GRID = np.linspace(0.0, 1.0, 201)


def _ahead(x: np.ndarray) -> np.ndarray:
    """p_b(x): chance that one set's register is ahead, given the share x of elements only it has."""
    return -np.log(1 - np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def unlikely(greater: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Pairs whose registers speak against the threshold.

    ``greater`` and ``smaller`` count registers where a is ahead of b or behind; with the set sizes they give
    the likelihood of each similarity. True where the likeliest similarity lies below the threshold
    and the threshold is far less likely.
    """
    out = np.zeros(len(n_a), dtype=bool)
    for at in range(0, len(n_a), 4096):
        part = slice(at, at + 4096)
        ahead, behind = greater[part, None], smaller[part, None]
        u = (n_a[part] / (n_a[part] + n_b[part]))[:, None]

        def log_likelihood(j: np.ndarray, u=u, ahead=ahead, behind=behind) -> np.ndarray:
            up = np.maximum(_ahead(u - (1 - u) * j), 1e-12)
            down = np.maximum(_ahead(1 - u - u * j), 1e-12)
            same = np.maximum(1 - up - down, 1e-12)
            return ahead * np.log(up) + behind * np.log(down) + (REGISTERS - ahead - behind) * np.log(same)

        all_j = log_likelihood(_GRID[None, :])
        best = all_j.argmax(axis=1)
        here = all_j[np.arange(len(best)), best]
        there = log_likelihood(np.array([[LEAST / OF]]))[:, 0]
        out[part] = (_GRID[best] < LEAST / OF) & (2 * (here - there) > UNLIKELY)
    return out


SKETCHES = arrow("doc_id long,mark long,n long,digest binary,registers binary")


def _sketch(source: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in source:
        ids, marks, rows = batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(), []
        texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
        for run in groups(texts):
            sets = shingle_sets([texts[i] for i in run], k)
            some = [s for s in sets if len(s)]
            sketches = iter(registers(some) if some else ())
            for i, s in zip(run, sets, strict=True):
                if len(s):
                    rows.append((ids[i], marks[i], len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), next(sketches).tobytes()))
                else:
                    rows.append((ids[i], marks[i], 0, None, None))
        yield from batches(rows, SKETCHES)


def _mark(of: str = "") -> F.Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.col(f"{of}doc_id").cast("long"), text_of(f"{of}text"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark().alias("mark"), text_of("text").cast("binary").alias("text"))


def sketch(docs: DataFrame, k: int = WORDS_IN_SHINGLE) -> DataFrame:
    """Per document: doc_id, mark of id and text, n (size of its set), digest of the set, registers."""
    return _texts(docs).mapInArrow(functools.partial(_sketch, k=k), "doc_id long, mark long, n long, digest binary, registers binary")


BAND_ROWS = arrow("key long,rep long,n long")


def _band(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        sketches = _matrix(batch.column("registers"))
        keys = band_keys(sketches)
        reps, n = (np.repeat(batch.column(c).to_numpy(), BANDS) for c in ("rep", "n"))
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(reps), pa.array(n)], schema=BAND_ROWS)


def _matrix(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=np.uint16).reshape(len(column), REGISTERS)


def _compatible(a: str, b: str) -> F.Column:
    """Sets of these sizes can reach the threshold."""
    return OF * F.least(a, b) >= LEAST * F.greatest(a, b)


PAIRS = arrow("a long,b long")


def _estimate(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        a, b = _matrix(batch.column("regs_a")), _matrix(batch.column("regs_b"))
        n_a, n_b = (batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b"))
        kept = ~unlikely((a > b).sum(axis=1), (a < b).sum(axis=1), n_a, n_b)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(kept)), batch.column("b").filter(pa.array(kept))], schema=PAIRS)


class _Place:
    """The block of members that ask in one place, with their sets; the others come by one at a time."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple[int, int, int, bytes, bytes]] = []
        self.ready = False

    def prepare(self) -> None:
        self.ready = True
        self.reps, self.comps, self.n = (np.array([r[i] for r in self.rows], dtype=np.int64) for i in range(3))
        self.sketches = np.frombuffer(b"".join(r[3] for r in self.rows), dtype=np.uint16).reshape(len(self.rows), REGISTERS)
        self.sets = shingle_sets([r[4] for r in self.rows], self.k)
        self.found: set[tuple[int, int]] = set()

    def meet(self, main: bool, rep: int, comp: int, n: int, sketch: np.ndarray, text: bytes) -> Iterator[tuple[int, int]]:
        """Links of one member with the block: other component, possible sizes, likely registers, full sets."""
        ask = (self.comps != comp) & (OF * np.minimum(self.n, n) >= LEAST * np.maximum(self.n, n))
        if not main:
            ask &= self.reps < rep  # two members of the rest meet once
        at = np.flatnonzero(ask)
        at = at[(self.sketches[at] == sketch).sum(axis=1) >= LEAST_EQUAL]
        if not len(at):
            return
        ahead, behind = (self.sketches[at] > sketch).sum(axis=1), (self.sketches[at] < sketch).sum(axis=1)
        at = at[~unlikely(ahead, behind, self.n[at].astype(np.float64), np.full(len(at), float(n)))]
        own = shingle_sets([text], self.k)[0] if len(at) else None
        for i in at.tolist():
            link = (int(self.comps[i]), comp)
            if link in self.found:
                continue  # these components are linked already
            both = common(own, self.sets[i])
            if OF * both >= LEAST * (len(own) + len(self.sets[i]) - both):
                self.found.add(link)
                yield int(self.reps[i]), rep


def _meet(source: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Links between different components in the places (cell, block, chunk), which come in order, askers first."""
    names = ("cell", "block", "chunk", "asks", "main", "rep", "component", "n", "registers", "text")
    place, here = None, _Place(k)
    for batch in source:
        links = []
        for cell, block, chunk, asks, main, rep, comp, n, registers, text in zip(
            *(batch.column(c).to_pylist() for c in names), strict=True
        ):
            if (cell, block, chunk) != place:
                place, here = (cell, block, chunk), _Place(k)
            if asks:
                here.rows.append((rep, comp, n, registers, text))
            elif here.rows:
                if not here.ready:
                    here.prepare()
                links += here.meet(main, rep, comp, n, np.frombuffer(registers, dtype=np.uint16), text)
        yield from batches(links, PAIRS)


def _confirm(source: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Links among the pairs of a and its partners: the text of a comes first, then those of its partners."""
    a, own = None, None
    for batch in source:
        texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
        sets, rows = shingle_sets(texts, k), []
        for left, right, s in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), sets, strict=True):
            if right is None:
                a, own = left, s
                continue
            if left != a:
                raise ValueError("partners came without the text they belong to")
            both = common(own, s)
            if OF * both >= LEAST * (len(own) + len(s) - both):
                rows.append((left, right))
        yield from batches(rows, PAIRS)


def confirmed(pairs: DataFrame, texts: DataFrame, k: int = WORDS_IN_SHINGLE) -> DataFrame:
    """The pairs whose full sets reach the threshold; a much-paired text is met in chunks of partners."""
    chunks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("chunks"))
    pairs = pairs.join(chunks, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"))
    texts = texts.select("rep", "text")
    partners = pairs.join(texts.withColumnRenamed("rep", "b"), "b").select("a", "chunk", "b", "text")
    heads = chunks.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    heads = heads.join(texts.withColumnRenamed("rep", "a"), "a").select("a", "chunk", F.lit(None).cast("long").alias("b"), "text")
    dealt = heads.unionByName(partners).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return dealt.select("a", "b", "text").mapInArrow(functools.partial(_confirm, k=k), "a long, b long")


def _links_of_rest(members: DataFrame, labels: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Links between different components of one bucket.

    Buckets with the same largest component form a cell. In a cell the members outside that component meet
    all members, in places of a block of the former and a chunk of the latter, both of bounded size.
    """
    label = labels.withColumnRenamed("id", "rep")
    rows = members.join(label, "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    sizes = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held"))
    cells = sizes.groupBy("key").agg(F.max(F.struct("held", "component"))["component"].alias("cell"), F.count(F.lit(1)).alias("parts"))
    nodes = rows.join(cells.filter("parts > 1").select("key", "cell"), "key").select("cell", "rep", "component").distinct()
    nodes = cut(nodes.join(texts.select("rep", "n"), "rep"))
    main, weight = F.col("component") == F.col("cell"), F.col("n") + ROW_WEIGHT
    plan = nodes.groupBy("cell").agg(
        F.ceil(F.sum(F.when(~main, weight)) / BLOCK).cast("int").alias("blocks"), F.ceil(F.sum(weight) / CHUNK).cast("int").alias("chunks")
    )
    rows = nodes.join(plan, "cell").join(texts.select("rep", "registers", "text"), "rep")
    place, keep = F.xxhash64("rep"), ("rep", "component", "n", "registers", "text")
    block, chunk = F.pmod(place, F.col("blocks")).cast("int"), F.pmod(place, F.col("chunks")).cast("int")

    def every(column: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(column) - 1))

    asking = rows.filter(~main).select("cell", block.alias("block"), every("chunks").alias("chunk"), F.lit(True).alias("asks"), main.alias("main"), *keep)
    asked = rows.select("cell", every("blocks").alias("block"), chunk.alias("chunk"), F.lit(False).alias("asks"), main.alias("main"), *keep)
    dealt = asking.unionByName(asked).repartition("cell", "block", "chunk")
    return dealt.sortWithinPartitions("cell", "block", "chunk", F.desc("asks")).mapInArrow(functools.partial(_meet, k=k), "a long, b long")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links between their components."""
    a = labels.select(F.col("id").alias("a"), F.col("component").alias("root_a"))
    b = labels.select(F.col("id").alias("b"), F.col("component").alias("root_b"))
    joined = links.join(a, "a", "left").join(b, "b", "left")
    over = components(joined.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    more = over.select(F.col("id").alias("component"), F.col("component").alias("root"))
    moved = labels.join(more, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
    return moved.unionByName(over.join(labels.select("id"), "id", "left_anti"))


def _groups(docs: DataFrame, k: int) -> DataFrame:
    """Per row: doc_id, mark, n_shingles, and the first (doc_id, mark) of its component, null for rows that take no part."""
    sketches = written(sketch(docs, k))
    usable = sketches.filter("n > 0 AND doc_id IS NOT NULL")
    least = usable.groupBy("digest").agg(F.min(F.struct("doc_id", "mark")).alias("first")).select("digest", "first.*")
    reps = usable.join(least, ["digest", "doc_id", "mark"], "left_semi").dropDuplicates(["digest"])
    # the written numbers of the classes stay as they are, whatever is computed again
    reps = written(reps.select(F.monotonically_increasing_id().alias("rep"), "digest", "doc_id", "mark", "n", "registers"))
    bands = reps.select("rep", "n", "registers").mapInArrow(_band, "key long, rep long, n long")
    shared = bands.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("pivot"), F.count(F.lit(1)).alias("held")).filter("held > 1")
    members = cut(bands.join(shared.select("key", "pivot"), "key"))
    stars = members.select("pivot.*", F.col("rep").alias("b"), F.col("n").alias("n_b")).withColumnsRenamed({"rep": "a", "n": "n_a"})
    stars = stars.filter(_compatible("n_a", "n_b") & (F.col("a") != F.col("b"))).distinct()
    of = lambda side: reps.select(F.col("rep").alias(side), F.col("registers").alias(f"regs_{side}"))
    likely = cut(stars.join(of("b"), "b").join(of("a"), "a").mapInArrow(_estimate, "a long, b long"))
    met = written(reps.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", "doc_id", "mark", "n", "registers"))
    wanted = met.select("mark")
    if met.count() <= MOST_IDS_SENT:
        wanted = F.broadcast(wanted)
    texts = _texts(docs).join(wanted, "mark", "left_semi").dropDuplicates(["doc_id", "mark"])
    texts = written(texts.join(met, ["doc_id", "mark"]).select("rep", "n", "registers", "text"))
    labels = cut(components(confirmed(likely, texts, k)))
    labels = _relabelled(labels, _links_of_rest(members.select("key", "rep"), labels, texts, k))
    classes = reps.select("rep", "digest", "doc_id", "mark").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    classes = cut(classes.select("digest", F.coalesce("component", "rep").alias("component"), F.struct("doc_id", "mark").alias("own")))
    firsts = classes.groupBy("component").agg(F.min("own").alias("first"))
    classes = classes.join(firsts, "component").select("digest", "first")
    rows = sketches.select("doc_id", "mark", F.col("n").alias("n_shingles"), "digest").join(classes, "digest", "left")
    first = F.coalesce("first", F.struct("doc_id", "mark"))
    return rows.select("doc_id", "mark", "n_shingles", F.when(F.col("doc_id").isNotNull(), first).alias("first"))


def near_groups(docs: DataFrame, k: int = WORDS_IN_SHINGLE) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept; shingles have ``k`` words."""
    component = F.col("first.doc_id")
    return _groups(docs, k).select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


def drop_near_copies(docs: DataFrame, k: int = WORDS_IN_SHINGLE) -> DataFrame:
    """The rows of ``docs`` that stand for their component, with all columns.

    Of several texts of one component under its smallest id, one stays. Rows without an id stay, and so do
    rows that repeat both id and text of one that stays.
    """
    gone = _groups(docs, k).filter("first.doc_id <> doc_id OR first.mark <> mark").select("doc_id", "mark").distinct().alias("gone")
    same = (F.col("gone.doc_id") == F.col("d.doc_id").cast("long")) & (F.col("gone.mark") == _mark("d."))
    return docs.alias("d").join(gone, same, "left_anti").select(*docs.columns)
