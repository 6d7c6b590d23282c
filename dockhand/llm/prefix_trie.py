"""Prefix trie of conversations by an Euler tour.

Conversations are first rebuilt: the first turns of the conversation that
starts their hundred, then their own. A node is a distinct sequence of first
turns. Its key is made of running sums: every turn gives, by the SHA-256 of its
place and content, nine numbers of 28 bits, and the sums over a conversation's
first d turns name its prefix of depth d. So texts never leave their rows and
a long conversation is no chain that one task has to follow.

Of a node's members the smallest names it, so the nodes of one conversation
are a path down the trie, and children are ordered by name: a path goes on
with the first child. Every node has an enter and an exit arc. Arcs that
follow each other on one path are a run: runs start where a path enters a
block of ``BLOCK`` depths or leaves one, and at the exit of a node with
children of other paths. Each run knows the run after it, and the list of runs
is ranked by pointer jumping: in each round every run adds the distance of the
run it points to and takes over its pointer. A run's rank gives its arcs
their positions in the tour; over the positions run prefix sums of leaves and
of savings, and a subtree's sum is the difference between the exit and the
enter arc of its top.

Nothing of a conversation, node or path meets in one task: running sums go
over ranges of the sorted rows with a carry for each partition, windows over
blocks of a path, counts and minima are combined before their shuffle, the
children of the (at most ``HOT``) nodes that have over one in ``HOT`` of all
nodes as children find their parent by broadcast. SHA-256 over the members
that end at one node is a chain by nature: their ids are joined to texts of
``IDS_IN_TEXT`` ids in range partitions, and only these texts meet.

Defined results: null roles and texts are empty; rows of one turn are ordered
by the SHA-256 of role and text, rows without a turn come first; rows without
a conversation are in no conversation; ``conv_id % 100`` has the sign of the id, as in SQL; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.common import arrow, batches, cut, many, text_of, written

HUNDRED = 100
SHARED_TURNS = 6  # a conversation takes fewer than these from the start of its hundred
LANES = 9
BLOCK = 1024  # depths in a block of a path
HOT = 1000
IDS_IN_TEXT = 1 << 16

TEXTS = arrow("key binary,first long,ids string")
DIGESTS = arrow("key binary,ends_sha256 string")


def _running(keys: list[str], sums: list[str], names: list[str]):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before, key, head, held, first = np.zeros(len(sums), dtype=np.int64), None, True, None, True
        for batch in source:
            if not batch.num_rows:
                continue
            if held is not None:
                yield close(held, False)
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows, dtype=bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            opening = tuple(c[0] for c in columns)
            change[0] = key is not None and opening != key
            starts = np.maximum.accumulate(np.where(change, np.arange(len(change)), 0))
            own = ~np.logical_or.accumulate(change)  # rows of the segment that goes on from the batch before
            totals = []
            for at, name in enumerate(sums):
                values = batch.column(name).to_numpy(zero_copy_only=False)
                total = np.cumsum(values)
                total = np.where(own, total + before[at], total - (total - values)[starts])
                totals.append(total)
                before[at] = total[-1]
            heads = own & head
            head, key = bool(heads[-1]), tuple(c[-1] for c in columns)
            held = [*batch.columns, *map(pa.array, totals)], heads, first
            first = False
        if held is not None:
            yield close(held, True)

    def close(held: tuple, last: bool) -> pa.RecordBatch:
        columns, heads, first = held
        part, n = TaskContext.get().partitionId(), len(heads)
        edge = np.zeros(n, dtype=np.int32)
        edge[0] += first
        edge[-1] += 2 * last
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(heads), pa.array(edge)], names=names)

    return run


def running_sums(rows: DataFrame, keys: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """The rows with ``r_<name>``, the running sum of each long of ``sums`` among equal ``keys`` (longs) in ``order``.

    The rows are sorted over range partitions and written. A key whose rows
    lie in several partitions is carried on by their totals: two rows a
    partition are read by the driver. Runs jobs when called.
    """
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [f"r_{c} long" for c in sums])
    names = [*rows.columns, *(f"r_{c}" for c in sums), "part", "head", "edge"]
    dealt = rows.repartitionByRange(many(rows), *keys, *order).sortWithinPartitions(*keys, *order)
    done = written(dealt.mapInArrow(_running(keys, sums, names), f"{schema}, part int, head boolean, edge int"))
    edges = done.filter("edge > 0").select("part", "edge", "head", F.struct(*keys, F.lit(0).alias("none")).alias("key"), F.struct(*[f"r_{c}" for c in sums]).alias("sums"))
    offsets, carry = [], None
    for row in sorted(edges.collect(), key=lambda r: (r["part"], r["edge"])):
        if row["edge"] in (1, 3):
            offset = carry[1] if carry and carry[0] == row["key"] else [0] * len(sums)
            if any(offset):
                offsets.append((row["part"], *offset))
        if row["edge"] in (2, 3):
            carry = row["key"], [s + o for s, o in zip(row["sums"], offset if row["head"] else [0] * len(sums), strict=True)]
    if not offsets:
        return done.drop("part", "head", "edge")
    carried = rows.sparkSession.createDataFrame(offsets, ", ".join(["part int", *(f"o_{c} long" for c in sums)]))
    found = done.join(F.broadcast(carried), "part", "left")  # at most one row a partition
    whole = {f"r_{c}": F.col(f"r_{c}") + F.when(F.col("head"), F.coalesce(f"o_{c}", F.lit(0))).otherwise(0) for c in sums}
    return found.withColumns(whole).drop("part", "head", "edge", *(f"o_{c}" for c in sums))


def placed_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest and chars of every turn."""
    role, text = text_of("role"), text_of("text")
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"),
        F.char_length(text).cast("long").alias("chars"), F.lit(1).cast("long").alias("one"),
    )
    done = running_sums(rows, ["conv_id"], ["turn", "digest"], ["one"])
    return done.select("conv_id", F.col("r_one").alias("pos"), "digest", "chars")


def conversations_of(placed: DataFrame) -> DataFrame:
    """conv_id, base, own (turns left out of its own), shared (turns taken from the base), length of every rebuilt conversation."""
    counts = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS
    convs = counts.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % HUNDRED).alias("base"), taken.alias("own"))
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    shared = F.least("own", F.coalesce("base_n", F.lit(0)))
    return convs.join(bases, "base", "left").select(
        "conv_id", "base", "own", shared.alias("shared"), (shared + F.greatest(F.col("n") - F.col("own"), F.lit(0))).alias("length")
    )


def rebuilt_turns(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), digest, chars and last of every rebuilt turn."""
    starts = placed.filter((F.col("conv_id") % HUNDRED == 0) & (F.col("pos") < SHARED_TURNS))
    first = convs.join(starts.withColumnRenamed("conv_id", "base"), "base").filter(F.col("pos") <= F.col("own"))
    later = placed.join(convs, "conv_id").filter(F.col("pos") > F.col("own"))
    depth = {"first": F.col("pos"), "later": F.col("pos") - F.col("own") + F.col("shared")}
    return first.select("conv_id", depth["first"].alias("depth"), "digest", "chars", (depth["first"] == F.col("length")).alias("last")).unionByName(
        later.select("conv_id", depth["later"].alias("depth"), "digest", "chars", (depth["later"] == F.col("length")).alias("last"))
    )


def _key(depth: Column, lanes: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat_ws(",", depth.cast("string"), *(x.cast("string") for x in lanes)).cast("binary"), 256))


def root_key() -> Column:
    return _key(F.lit(0), [F.lit(0)] * LANES)


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """conv_id, depth, key, parent_key, chars, last: the node of every rebuilt turn."""
    names = [f"l{i}" for i in range(LANES)]
    content = F.sha2(F.concat(F.col("depth").cast("string").cast("binary"), F.lit(b":"), "digest"), 256)
    rows = rebuilt.withColumn("content", content).select(
        "conv_id", "depth", "chars", "last",
        *(F.conv(F.substring("content", 7 * i + 1, 7), 16, 10).cast("long").alias(n) for i, n in enumerate(names)),
    )
    done = running_sums(rows, ["conv_id"], ["depth"], names)
    key = _key(F.col("depth"), [F.col(f"r_{n}") for n in names])
    parent = _key(F.col("depth") - 1, [F.col(f"r_{n}") - F.col(n) for n in names])
    return done.select("conv_id", "depth", key.alias("key"), parent.alias("parent_key"), "chars", "last")


def trie_nodes(found: DataFrame, convs: DataFrame) -> DataFrame:
    """key, depth, chars, n_convs, conv_id, n_children, goes_on, parent of every node.

    ``goes_on`` tells whether the first child is of the same path, ``parent``
    is the name of the parent. Runs jobs when called.
    """
    grouped = found.groupBy("key", "parent_key", "depth", "chars").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(root_key().alias("key"), F.lit(None).cast("binary").alias("parent_key"), zero.alias("depth"), zero.alias("chars"), "n_convs", "conv_id")
    nodes = written(grouped.unionByName(root))
    children = nodes.filter("depth > 0").groupBy(F.col("parent_key").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("conv_id").alias("first_child")
    )
    nodes = written(
        nodes.join(children, "key", "left").select(
            *nodes.columns,
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.coalesce(F.col("first_child") == F.col("conv_id"), F.lit(False)).alias("goes_on"),
        )
    )
    names = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"), "n_children")
    most = nodes.count() // HOT
    hot = names.filter(F.col("n_children") > most).select("parent_key", F.col("parent").alias("hot_parent"))
    below = nodes.filter("depth > 0").join(F.broadcast(hot), "parent_key", "left")  # at most HOT rows: their children are nodes
    by_hot = below.filter("hot_parent IS NOT NULL").withColumn("parent", F.col("hot_parent"))
    cold = names.filter((F.col("n_children") > 0) & (F.col("n_children") <= most)).drop("n_children")
    by_key = below.filter("hot_parent IS NULL").join(cold, "parent_key")
    top = nodes.filter("depth = 0").withColumn("parent", F.lit(None).cast("long"))
    columns = ["key", "depth", "chars", "n_convs", "conv_id", "n_children", "goes_on", "parent"]
    return written(top.select(*columns).unionByName(by_hot.select(*columns)).unionByName(by_key.select(*columns)))


def tour_runs(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes with the runs of their arcs, and the linked list of runs.

    A run is named by its conversation and a code: twice the depth of its
    first arc, plus one if that is an exit arc. Nodes get ``enter_code``,
    ``enter_at`` (place in the run), ``exit_code`` and ``exit_at``; runs are
    conv_id, code, next_conv, next_code, weight (arcs).
    """
    tops = nodes.filter((F.col("parent") != F.col("conv_id")) | F.col("parent").isNull()).select("parent", "depth", "conv_id")
    branches = cut(tops.filter("parent IS NOT NULL").groupBy("parent", "depth").agg(F.min("conv_id").alias("first_top")))
    one = tops.filter("parent IS NOT NULL").withColumn("one", F.lit(1).cast("long"))
    ranked = running_sums(one, [], ["parent", "depth", "conv_id"], ["one"]).select("parent", "depth", "conv_id", F.col("r_one").alias("at"))
    after = ranked.select("parent", "depth", (F.col("at") - 1).alias("at"), F.col("conv_id").alias("next_top"))
    following = ranked.select("parent", "depth", "at", "conv_id").join(after, ["at", "parent", "depth"]).select("conv_id", "next_top")

    below = branches.select(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth"), "first_top")
    block = Window.partitionBy("conv_id", "block")
    downward = block.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (
        nodes.join(below, ["conv_id", "depth"], "left")
        .withColumn("block", F.floor(F.col("depth") / BLOCK))
        .withColumn("low", F.min("depth").over(block))
        .withColumn("high", F.max("depth").over(block))
        .withColumn("starts", F.col("first_top").isNotNull() | (F.col("depth") == F.col("high")))
        .withColumn("exit_start", F.last(F.when(F.col("starts"), F.col("depth")), ignorenulls=True).over(downward))
        .withColumn("ends", F.coalesce(F.lag("starts").over(block.orderBy("depth")), F.lit(True)))
        .withColumn("top", F.col("parent").isNull() | (F.col("parent") != F.col("conv_id")))
    )
    rows = written(rows)
    depth = F.col("depth")
    located = rows.select(
        "key", "depth", "chars", "n_convs", "conv_id", "n_children", "parent",
        (2 * F.col("low")).alias("enter_code"), (depth - F.col("low")).alias("enter_at"),
        (2 * F.col("exit_start") + 1).alias("exit_code"), (F.col("exit_start") - depth).alias("exit_at"),
    )
    enters = rows.filter(depth == F.col("high")).select(
        "conv_id",
        (2 * F.col("low")).alias("code"),
        F.when(~F.col("goes_on") & F.col("first_top").isNotNull(), F.col("first_top")).otherwise(F.col("conv_id")).alias("next_conv"),
        F.when(F.col("goes_on") | F.col("first_top").isNotNull(), 2 * (depth + 1)).otherwise(2 * depth + 1).alias("next_code"),
        (depth - F.col("low") + 1).alias("weight"),
    )
    here = branches.select(F.col("parent").alias("conv_id"), "depth", F.col("first_top").alias("side"))
    ending = rows.filter("ends").select("conv_id", "depth", "exit_start", "top", "parent").join(here, ["conv_id", "depth"], "left").join(following, "conv_id", "left")
    turn = F.when(F.col("top"), F.col("next_top")).otherwise(F.col("side"))  # the next path to enter, if there is one
    exits = ending.select(
        "conv_id",
        (2 * F.col("exit_start") + 1).alias("code"),
        F.coalesce(turn, "parent").alias("next_conv"),
        F.when(turn.isNotNull(), 2 * depth).otherwise(2 * (depth - 1) + 1).alias("next_code"),
        (F.col("exit_start") - depth + 1).alias("weight"),
    )
    return located, enters.unionByName(exits)


def ranked(runs: DataFrame) -> DataFrame:
    """(conv_id, code, to_end): arcs from the start of each run to the end of the list, by pointer jumping.

    A run that has reached the end looks itself up and stays as it is, so a
    run is looked up by itself and by one other at most. Runs a job for every
    doubling of the list.
    """
    state = cut(runs.withColumnRenamed("weight", "to_end"))
    for _ in range(max(state.count() - 1, 0).bit_length()):
        ended = F.col("next_conv").isNull()
        going = state.withColumns(
            {"ahead_conv": F.coalesce("next_conv", "conv_id"), "ahead_code": F.when(ended, F.col("code")).otherwise(F.col("next_code"))}
        )
        ahead = state.select(
            F.col("conv_id").alias("ahead_conv"), F.col("code").alias("ahead_code"),
            F.col("next_conv").alias("then_conv"), F.col("next_code").alias("then_code"), F.col("to_end").alias("rest"),
        )
        state = cut(
            going.join(ahead, ["ahead_conv", "ahead_code"]).select(
                "conv_id", "code", F.col("then_conv").alias("next_conv"), F.col("then_code").alias("next_code"),
                F.when(ended, F.col("to_end")).otherwise(F.col("to_end") + F.col("rest")).alias("to_end"),
            )
        )
    return state.select("conv_id", "code", "to_end")


def subtree_sums(located: DataFrame, ranks: DataFrame) -> DataFrame:
    """conv_id, depth, n_leaves, saved_tokens of every node, by prefix sums over the tour."""
    leaf = (F.col("n_children") == 0).cast("long")
    saving = (F.col("n_convs") - 1) * F.col("chars")
    # positions are counted from the end of the tour, which is 0
    arcs = located.select(
        "conv_id", "depth", leaf.alias("leaf"), saving.alias("saving"),
        F.explode(F.array(F.struct(F.col("enter_code").alias("code"), F.col("enter_at").alias("at"), F.lit(True).alias("enters")),
                          F.struct(F.col("exit_code").alias("code"), F.col("exit_at").alias("at"), F.lit(False).alias("enters")))).alias("arc"),
    ).select("conv_id", "depth", "leaf", "saving", "arc.*")
    at = arcs.join(ranks, ["conv_id", "code"]).select(
        "conv_id", "depth", (F.col("at") - F.col("to_end")).alias("position"),
        F.when(F.col("enters"), F.col("leaf")).otherwise(0).alias("leaf"), F.when(F.col("enters"), F.col("saving")).otherwise(0).alias("saving"),
    )
    sums = running_sums(at, [], ["position"], ["leaf", "saving"])
    # at the enter arc the sum holds the node itself, at the exit arc its whole subtree
    return sums.groupBy("conv_id", "depth").agg(
        (F.max("r_leaf") - F.min("r_leaf") + F.max("leaf")).alias("n_leaves"),
        (F.max("r_saving") - F.min("r_saving") + F.max("saving")).alias("saved_tokens"),
    )


def _texts(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, ids, rows = None, [], []
    for batch in source:
        for at, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if at != key or len(ids) == IDS_IN_TEXT:
                if ids:
                    rows.append((key, ids[0], ",".join(map(str, ids))))
                key, ids = at, []
            ids.append(conv)
        yield from batches(rows, TEXTS)
        rows = []
    if ids:
        yield from batches([(key, ids[0], ",".join(map(str, ids)))], TEXTS)


def _digests(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest, rows = None, None, []
    for batch in source:
        for at, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if at != key:
                if digest is not None:
                    rows.append((key, digest.hexdigest()))
                key, digest = at, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        yield from batches(rows, DIGESTS)
        rows = []
    if digest is not None:
        yield from batches([(key, digest.hexdigest())], DIGESTS)


def ends_digests(found: DataFrame, convs: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ids of the conversations that end at a node, in ascending order."""
    ends = found.filter("last").select("key", "conv_id").unionByName(convs.filter("length = 0").select(root_key().alias("key"), "conv_id"))
    dealt = ends.repartitionByRange(many(ends), "key", "conv_id").sortWithinPartitions("key", "conv_id")
    texts = dealt.mapInArrow(_texts, "key binary, first long, ids string")
    met = texts.repartition("key").sortWithinPartitions("key", "first")
    return met.mapInArrow(_digests, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node. Runs jobs when called."""
    placed = placed_turns(turns)
    convs = cut(conversations_of(placed))
    found = prefixes(rebuilt_turns(placed, convs))
    located, runs = tour_runs(trie_nodes(found, convs))
    sums = subtree_sums(located, ranked(runs))
    return (
        located.join(ends_digests(found, convs), "key", "left")
        .join(sums, ["conv_id", "depth"])
        .select(
            "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def twin_sql() -> str:
    """The same as DuckDB SQL, which meets every node with all its ancestors."""
    crc = """xor(list_reduce(list_prepend(4294967295, list_transform(range(8 * strlen(c)),
        lambda i: CASE WHEN i % 8 = 0 THEN CAST(ascii(substr(c, i // 8 + 1, 1)) AS BIGINT) ELSE 0 END)),
        lambda x, y: xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1))), 4294967295)"""
    return f"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % {HUNDRED} AS base, {crc} % {SHARED_TURNS} AS h
            FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS c FROM turns)
        ), rebuilt AS (
            SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
            UNION ALL
            SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
        ), p AS MATERIALIZED (
            SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars,
                   list(sha256(length(role) || ':' || role || text)) OVER (w ROWS UNBOUNDED PRECEDING) AS key
            FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)
            UNION ALL SELECT conv_id, 0, 0, [] FROM convs
        ), lengths AS (
            SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id
        ), nodes AS MATERIALIZED (
            SELECT p.key, p.depth, any_value(p.chars) AS chars, count(*) AS n_convs, min(p.conv_id) AS conv_id,
                   sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (l.depth = p.depth), '')) AS ends_sha256
            FROM p JOIN lengths l USING (conv_id) GROUP BY p.key, p.depth
        ), children AS (
            SELECT key[1:depth - 1] AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
        ), held AS MATERIALIZED (
            SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (key)
        ), below AS (
            SELECT p.key, count(*) FILTER (h.n_children = 0) AS n_leaves, sum((h.n_convs - 1) * h.chars) AS saved
            FROM held h JOIN p ON p.conv_id = h.conv_id AND p.depth <= h.depth GROUP BY p.key
        )
        SELECT h.conv_id, CAST(h.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, h.n_convs, h.n_children, b.n_leaves,
               CAST(b.saved AS BIGINT) AS saved_tokens, h.ends_sha256
        FROM held h JOIN below b USING (key) LEFT JOIN nodes u ON h.depth > 0 AND u.key = h.key[1:h.depth - 1]
    """
