"""Exact top-k inner-product search with multi-resolution segment statistics.

Every vector is cut into equal segments at several resolutions and keeps the
mean and deviation of each segment. For a query q and a vector x the squared
distance is at least the sum over segments of L * ((mq - mx)^2 + (sq - sx)^2),
so the inner product (|q|^2 + |x|^2 - d^2) / 2 is at most what that bound
gives, which is the product of the two rows of statistics. Bounds are taken
coarse to fine; a vector is dropped for a query once its bound is below the
k-th best exact score found so far, and the survivors get exact integer scores.
Vectors and queries are packed, and every cell pairs one group of queries with
one group of vectors: its task holds the queries and lets the vectors pass in
blocks, so the best scores so far are carried from block to block.

Defined results: vectors that are null or hold null or non-finite components
take no part; rows that repeat an id and its vector count once; rows with one
id and several vectors are all candidates, and the query of that id is the
smallest of them in array order; a query never meets rows of its own id; vectors of other
lengths than the query's are no candidates; fewer candidates than k are all
returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.common import arrow, written

K = 5
SCALE = 256
QUERY_STEP = 50
VECTORS_IN_BLOCK = 2048
QUERIES_IN_BLOCK = 256
RESOLUTIONS = (1, 4, 16)
FIRST_VECTORS = 256  # they give the first floors
VALUES_IN_GROUP = 1 << 22  # components of one group, of queries or of vectors
CELLS_A_CORE = 4
PACKED_BYTES = 8 << 20
DENSE = 32  # from one pair of so many, survivors are scored by a matrix product
EXACT = 2.0**52  # float64 holds all whole numbers up to here


def segment_statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(L) * (mean, deviation) per segment, so that distances add up; float64, (n, 2 * segments)."""
    bounds = np.linspace(0, rows.shape[1], segments + 1).astype(int)
    lengths = np.diff(bounds)
    sums = np.add.reduceat(rows, bounds[:-1], axis=1)
    squares = np.add.reduceat(rows * rows, bounds[:-1], axis=1)
    means = sums / lengths
    deviations = np.sqrt(np.maximum(squares / lengths - means * means, 0))
    return np.hstack([means, deviations]) * np.sqrt(np.tile(lengths, 2))


def _exact(queries: np.ndarray, vectors: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    out = np.empty(len(pairs[0]), dtype=np.int64)
    for at in range(0, len(out), 1 << 15):
        part = slice(at, at + (1 << 15))
        out[part] = np.einsum(
            "ij,ij->i", queries[pairs[0][part]].astype(np.int64), vectors[pairs[1][part]].astype(np.int64)
        )
    return out


class Block:
    """Rows of one length with their statistics, and a last column of 1 (queries) or the slack of their bounds (vectors)."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, asked: bool):
        self.ids, self.values, self.floats = ids, values, values.astype(np.float64)
        norms = np.einsum("ij,ij->i", self.floats, self.floats)
        self.longest = float(np.sqrt(norms.max(initial=0)))
        # float rounding stays far below this, while scores are whole numbers
        self.slack = 1e-6 * norms
        last = np.ones((len(ids), 1)) if asked else self.slack[:, None]
        self.levels = [np.hstack([segment_statistics(self.floats, s), last]) for s in RESOLUTIONS if s <= values.shape[1]]


class Queries:
    """A block of queries and the k best vectors each has met: by query, best score, smallest id."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, k: int):
        self.k, self.block = k, Block(ids, values, asked=True)
        self.rows, self.ids, self.scores = (np.empty(0, dtype=np.int64) for _ in range(3))
        # of every query's k-th best
        self.full, self.kth, self.kth_id = np.zeros(len(ids), dtype=bool), *np.zeros((2, len(ids)), dtype=np.int64)

    def meet(self, x: Block) -> None:
        q = self.block
        floor = np.where(self.full, self.kth, -np.inf)
        least = (floor - q.slack - 1e-6)[:, None]
        alive = np.ones((len(q.ids), len(x.ids)), dtype=bool)
        own = np.flatnonzero(np.isin(x.ids, q.ids))
        alive[:, own] = q.ids[:, None] != x.ids[own][None, :]
        left = np.count_nonzero(alive)
        for a, b in zip(q.levels, x.levels, strict=True):
            if left * DENSE < alive.size:
                break
            alive &= a @ b.T >= least
            left = np.count_nonzero(alive)
        if left * DENSE >= alive.size and q.longest * x.longest < EXACT:
            scores = q.floats @ x.floats.T
            if not self.full.all() and len(x.ids) > self.k:
                best = np.partition(np.where(alive, scores, -np.inf), -self.k, axis=1)[:, -self.k]
                floor = np.maximum(floor, best)
            alive &= scores >= floor[:, None]
            rows, columns = np.nonzero(alive)
            found = scores[rows, columns].astype(np.int64)
        else:
            rows, columns = np.nonzero(alive)
            found = _exact(q.values, x.values, (rows, columns))
        self._add(rows, x.ids[columns], found)

    def _add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        kth = self.kth[rows]
        better = ~self.full[rows] | (scores > kth) | (scores == kth) & (ids < self.kth_id[rows])
        if not better.any():
            return
        rows = np.concatenate([self.rows, rows[better]])
        ids, scores = np.concatenate([self.ids, ids[better]]), np.concatenate([self.scores, scores[better]])
        ranked = np.lexsort((ids, ~scores, rows))
        rows = rows[ranked]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        ranked = ranked[rank < self.k]
        self.rows, self.ids, self.scores = rows[rank < self.k], ids[ranked], scores[ranked]
        ends = np.flatnonzero(rank[rank < self.k] == self.k - 1)
        at = self.rows[ends]
        self.full[at], self.kth[at], self.kth_id[at] = True, self.scores[ends], self.ids[ends]


class Group:
    """The queries of one cell; its vectors come piece by piece and are met in blocks."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, k: int):
        parts = (slice(at, at + QUERIES_IN_BLOCK) for at in range(0, len(ids), QUERIES_IN_BLOCK))
        self.queries = [Queries(ids[part], values[part], k) for part in parts]
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.n, self.size = 0, FIRST_VECTORS

    def add(self, ids: np.ndarray, values: np.ndarray) -> None:
        self.held.append((ids, values))
        self.n += len(ids)
        if self.n >= self.size:
            self.flush()

    def flush(self) -> None:
        if self.n:
            ids, values = (np.concatenate(side) for side in zip(*self.held, strict=True))
            self.held, self.n, at = [], 0, 0
            while at < len(ids):
                part = slice(at, at + self.size)
                x = Block(ids[part], values[part], asked=False)
                for queries in self.queries:
                    queries.meet(x)
                at, self.size = at + self.size, VECTORS_IN_BLOCK

    def best(self) -> Iterator[pa.RecordBatch]:
        """(query id, vector id, score) of every query's k best vectors."""
        self.flush()
        for queries in self.queries:
            sides = (queries.block.ids[queries.rows], queries.ids, queries.scores)
            yield pa.RecordBatch.from_arrays([pa.array(side) for side in sides], schema=PAIRS)


PAIRS = arrow("query_id long,vec_id long,score long")
PACKED = arrow("dim int,block int,ids binary,width int,data binary")


def _narrow(values: np.ndarray) -> np.ndarray:
    low, high = values.min(initial=0), values.max(initial=0)
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


def _pack(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one length and block as bytes, in the fewest bytes a component that hold them."""

    def packed() -> pa.RecordBatch:
        rows = []
        for (dim, block), parts in held.items():
            ids, values = (np.concatenate(side) for side in zip(*parts, strict=True))
            rows.append((dim, block, ids.tobytes(), values.itemsize, values.tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(side, type=f.type) for side, f in zip(zip(*rows, strict=True), PACKED, strict=True)], schema=PACKED
        )

    held, size = defaultdict(list), 0
    for batch in source:
        dims, blocks = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("dim", "block"))
        order = np.lexsort((blocks, dims))
        dims, blocks, batch = dims[order], blocks[order], batch.take(pa.array(order))
        ids, lists = batch.column("vec_id").to_numpy(zero_copy_only=False), batch.column("values")
        starts = np.flatnonzero((np.diff(dims, prepend=-1) != 0) | (np.diff(blocks, prepend=-1) != 0))
        for at, end in pairwise([*starts, len(order)]):
            values = _narrow(lists.slice(at, end - at).flatten().to_numpy(zero_copy_only=False))
            held[int(dims[at]), int(blocks[at])].append((ids[at:end], values))
            size += values.nbytes + ids[at:end].nbytes
        if size >= PACKED_BYTES:
            yield packed()
            held, size = defaultdict(list), 0
    if held:
        yield packed()


def _search(k: int):
    def search(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asked, group = None, [], None
        for batch in source:
            keys = [batch.column(name).to_pylist() for name in ("dim", "q_block", "x_block", "side", "width")]
            for at, (dim, q_block, x_block, side, width) in enumerate(zip(*keys, strict=True)):
                if cell != (dim, q_block, x_block):
                    if group:
                        yield from group.best()
                    cell, asked, group = (dim, q_block, x_block), [], None
                ids = np.frombuffer(batch.column("ids")[at].as_buffer(), dtype=np.int64)
                values = np.frombuffer(batch.column("data")[at].as_buffer(), dtype=f"i{width}").reshape(len(ids), dim)
                if side == QUERY_SIDE:
                    asked.append((ids, values))
                elif asked:  # queries come first
                    group = group or Group(*(np.concatenate(x) for x in zip(*asked, strict=True)), k)
                    group.add(ids, values)
        if group:
            yield from group.best()

    return search


def integer_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Distinct (vec_id, values) with every component as floor(256 * x)."""
    x = F.col(column).cast("array<double>")
    usable = F.col(column).isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), usable.alias("ok"))
    rows = rows.filter("ok AND vec_id IS NOT NULL")
    return rows.select("vec_id", F.transform("x", lambda v: F.floor(v * SCALE)).alias("values")).distinct()


QUERY_SIDE, VECTOR_SIDE = 0, 1


def _blocks(rows: DataFrame, n: int) -> DataFrame:
    """``n`` blocks for each length of vectors, by a hash of id and vector, each in a few packed rows."""
    block = F.pmod(F.xxhash64("vec_id", "values"), F.lit(n)).cast("int").alias("block")
    keyed = rows.select(F.size("values").alias("dim"), block, "vec_id", "values")
    return keyed.mapInArrow(_pack, "dim int, block int, ids binary, width int, data binary")


def _grid(values: int, asked_values: int, vectors: int, cores: int) -> tuple[int, int]:
    """Groups of queries and of vectors: what a task holds is bounded, and small tables have cells for all cores."""
    n_q = max(1, -(-asked_values // VALUES_IN_GROUP))
    wanted = min(-(-vectors // VECTORS_IN_BLOCK), -(-CELLS_A_CORE * cores // n_q))
    return n_q, max(1, -(-values // VALUES_IN_GROUP), wanted)


def top_k(vectors: DataFrame, column: str = "embedding", k: int = K, step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every row whose id is divisible by ``step``."""
    rows = written(integer_vectors(vectors, column))
    is_asked, size = F.col("vec_id") % step == 0, F.size("values").cast("long")
    asked = rows.filter(is_asked).groupBy("vec_id").agg(F.min("values").alias("values"))
    counted = rows.agg(F.sum(size), F.sum(F.when(is_asked, size)), F.count("*")).first()
    n_q, n_x = _grid(*(n or 0 for n in counted), rows.sparkSession.sparkContext.defaultParallelism)
    # every group of vectors meets every group of queries of its length, each pair in a cell of its own
    packed = ["dim", "ids", "width", "data"]
    queries = _blocks(asked, n_q).select(
        *packed, F.lit(QUERY_SIDE).alias("side"), F.col("block").alias("q_block"),
        F.explode(F.sequence(F.lit(0), F.lit(n_x - 1))).alias("x_block"),
    )
    blocks = _blocks(rows, n_x).select(
        *packed, F.lit(VECTOR_SIDE).alias("side"), F.col("block").alias("x_block"),
        F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("q_block"),
    )
    cells = queries.unionByName(blocks).withColumn("cell", (F.col("q_block") * n_x + F.col("x_block") + F.col("dim")) % (n_q * n_x))
    dealt = cells.repartitionById(n_q * n_x, "cell").sortWithinPartitions("dim", "q_block", "x_block", "side")
    found = dealt.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
