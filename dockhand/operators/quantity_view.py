"""The quantity of every part in every product, kept current by signed changes.

A change of the bill of materials is a row with a sign: an insert counts +1, a
delete -1, an update is a delete of the old row and an insert of the new one.
A batch becomes one row per (product, part number) with the sum of signed
quantities and of signs, and only the stored rows of these keys are merged. A
group goes when no row is left in it, also when its quantities are 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockhand.sources.versioned import VersionedTable

KEY = ["ProductID", "PartNumber"]


def signed_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes that lead from one state of the bill to another: (its columns, sign). Rows repeat as often as they differ in number."""
    columns = old.columns
    both = old.withColumn("sign", F.lit(-1)).unionByName(new.withColumn("sign", F.lit(1)))
    net = both.groupBy(*columns).agg(F.sum("sign").cast("int").alias("net")).filter("net <> 0")
    return net.select(*columns, F.explode(F.array_repeat(F.signum("net").cast("int"), F.abs("net"))).alias("sign")).select(*columns, "sign")


def quantity_deltas(changes: DataFrame, parts: DataFrame) -> DataFrame:
    """(ProductID, PartNumber, TotalQuantity, Uses) to add; summed in every task before the shuffle."""
    return (
        changes.join(parts.select("PartID", "PartNumber"), "PartID")
        .groupBy(*KEY)
        .agg(F.sum(F.col("Quantity") * F.col("sign")).alias("TotalQuantity"), F.sum("sign").cast("long").alias("Uses"))
    )


def create_view(bom: DataFrame, parts: DataFrame, folder: str) -> VersionedTable:
    """The view of a whole bill, stored. Runs jobs."""
    view = VersionedTable(bom.sparkSession, folder, KEY)
    view.create(quantity_deltas(bom.withColumn("sign", F.lit(1)), parts))
    return view


def apply_changes(view: VersionedTable, changes: DataFrame, parts: DataFrame, batch: int) -> bool:
    """Add a batch of signed changes; False if it was applied before. Runs jobs."""

    def rule(met: DataFrame) -> DataFrame:
        def total(name: str):
            return F.coalesce(F.col(f"old.{name}"), F.lit(0)) + F.coalesce(F.col(f"new.{name}"), F.lit(0))

        summed = met.select(*KEY, total("TotalQuantity").alias("TotalQuantity"), total("Uses").alias("Uses"))
        return summed.filter(F.col("Uses") != 0)

    deltas = quantity_deltas(changes, parts).filter((F.col("TotalQuantity") != 0) | (F.col("Uses") != 0))
    return view.merge(deltas, rule, batch)


def start_quantity_view(changes: DataFrame, parts: DataFrame, view: VersionedTable, checkpoint_dir: str) -> StreamingQuery:
    """Keep the view current from a stream of signed changes; a replayed batch changes nothing."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        apply_changes(view, batch, parts, batch_id)
        batch.unpersist()

    return (
        changes.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
