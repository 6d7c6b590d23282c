"""Aggregates kept current while rows arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockhand.operators.manifests import latest_by_key
from dockhand.operators.monitor import processing_metrics
from dockhand.operators.products import product_part_quantity
from dockhand.sources.tables import overwrite_table


def start_live_metrics(log: DataFrame, table: str, checkpoint_dir: str) -> StreamingQuery:
    """Totals over the attempt log, stored as a one-row table after every batch."""

    def store(totals: DataFrame, _: int) -> None:
        overwrite_table(totals, table)

    return (
        processing_metrics(log)
        .writeStream.outputMode("complete")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def start_product_part_quantity(bom: DataFrame, parts: DataFrame, folder: str, checkpoint_dir: str) -> StreamingQuery:
    """Running quantity per product and part.

    Each batch writes only the totals it changed, into a subfolder of its own;
    :func:`current_product_part_quantity` reads the newest total per key.
    """

    def store(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch_id={batch_id}")

    return (
        product_part_quantity(bom, parts)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def current_product_part_quantity(changes: DataFrame) -> DataFrame:
    """Newest total per product and part."""
    newest = latest_by_key(changes, ["ProductID", "PartNumber"], [F.desc("batch_id")])
    return newest.select("ProductID", "PartNumber", "TotalQuantity")
