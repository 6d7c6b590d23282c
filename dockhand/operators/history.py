"""Audit trail from a stream of states, kept right when states come late or twice.

A state is the whole row of a key at a sequence number, or the news that the
key is deleted. All states are stored by (key, sequence); a batch rewrites only
the files that hold one of its keys and works the trail of these keys out
anew: what a state changed against the one before it, and until which later
change it holds. So a late state also mends its neighbours, and one that came
before (same key and sequence) is left out.

The columns are ``FileID``-like key, ``Seq``, ``Deleted`` and any number of values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockhand.sources.versioned import VersionedTable

SEQ, DELETED = "Seq", "Deleted"
DERIVED = ["Action", "ValidFrom", "ValidTo"]


def trail(states: DataFrame, key: str) -> DataFrame:
    """The states with Action (INSERT, UPDATE, DELETE; NULL if nothing changed), ValidFrom and ValidTo (sequence numbers).

    Equal states in a row are one; NULL equals NULL; a deletion of a key that
    is not there changes nothing.
    """
    values = [c for c in states.columns if c not in (key, SEQ, DELETED, *DERIVED)]
    order = Window.partitionBy(key).orderBy(SEQ)
    later = Window.partitionBy(key).orderBy(F.desc(SEQ)).rowsBetween(Window.unboundedPreceding, -1)
    now, before = F.struct(*values), F.col("__before")
    there = F.coalesce(~before[DELETED], F.lit(False))
    action = (
        F.when(F.col(DELETED), F.when(there, "DELETE"))
        .when(~there, "INSERT")
        .when(~now.eqNullSafe(F.struct(*(before[v].alias(v) for v in values))), "UPDATE")
    )
    changed = F.when(F.col("Action").isNotNull(), F.col(SEQ))
    return (
        states.select(key, SEQ, DELETED, *values)
        .withColumn("__before", F.lag(F.struct(DELETED, *values)).over(order))
        .withColumn("Action", action)
        .drop("__before")
        .withColumn("ValidFrom", changed)
        .withColumn("ValidTo", F.when(F.col("Action").isNotNull(), F.last(changed, ignorenulls=True).over(later)))
    )


def create(table: VersionedTable, states: DataFrame) -> VersionedTable:
    """A stored trail, by (key, Seq). Runs jobs."""
    table.create(trail(states, table.key[0]))
    return table


def apply_states(table: VersionedTable, states: DataFrame, batch: int | None = None) -> bool:
    """Add states; False if the batch was applied before. Runs jobs."""
    key = table.key[0]

    def rule(old: DataFrame, new: DataFrame) -> DataFrame:
        values = [c for c in new.columns if c not in (key, SEQ)]
        known = old.select(key, SEQ, F.struct(F.lit(0).alias("rank"), *values).alias("row"))
        came = new.select(key, SEQ, F.struct(F.lit(1).alias("rank"), *values).alias("row"))
        once = known.unionByName(came).groupBy(key, SEQ).agg(F.min("row").alias("row"))  # what was stored first stays
        return trail(once.select(key, SEQ, *(F.col(f"row.{v}").alias(v) for v in values)), key)

    return table.rewrite(states, [key], rule, batch)


def changes(stored: DataFrame) -> DataFrame:
    """The audit: one row per change, with the time it holds."""
    return stored.filter(F.col("Action").isNotNull()).drop(SEQ, DELETED)


def as_of(stored: DataFrame, seq: int) -> DataFrame:
    """The rows as they were right after ``seq``."""
    holds = (F.col("ValidFrom") <= seq) & (F.col("ValidTo").isNull() | (F.col("ValidTo") > seq))
    return stored.filter(holds & (F.col("Action") != "DELETE")).drop(SEQ, DELETED, *DERIVED)


def start_history(states: DataFrame, table: VersionedTable, checkpoint_dir: str) -> StreamingQuery:
    """Keep a stored trail current from a stream of states; a replayed batch changes nothing."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        apply_states(table, batch, batch_id)
        batch.unpersist()

    return states.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
