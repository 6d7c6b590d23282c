"""Row numbers and running totals that do not put one group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockhand.session import ensure_checkpoint_dir

_PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the row ordinal in the low 33 bits


def split_row_number(
    df: DataFrame, keys: list[str], bucket: Column, order: list[Column], name: str = "row_num"
) -> DataFrame:
    """Row number per key, computed per (key, bucket) and shifted by earlier buckets.

    ``bucket`` must grow with ``order`` (a time truncated to the hour, say).
    A key holding a large share of all rows is spread over its buckets; only
    bucket counts, one row each, are ordered per key.
    """
    marked = df.withColumn("__bucket", bucket)
    sizes = marked.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "__bucket", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset"))
    local = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    return (
        marked.withColumn("__local", F.row_number().over(local))
        .join(offsets, [*keys, "__bucket"])
        .withColumn(name, (F.col("__offset") + F.col("__local")).cast("long"))
        .drop("__bucket", "__offset", "__local")
    )


def surrogate_keys(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Dense keys ``start, start+1, ...`` over the whole table in ``order``.

    One range shuffle sorts the rows; each row then knows its place inside its
    partition, and the partition sizes (one row per partition) give the
    offsets. The sorted rows are checkpointed so that both uses see the same
    partitions even when an executor is lost. Runs jobs when called.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = df.orderBy(*order).withColumn("__place", F.monotonically_increasing_id()).checkpoint()
    partition = F.shiftright(F.col("__place"), _PARTITION_SHIFT)
    sizes = placed.groupBy(partition.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset"))
    ordinal = F.col("__place").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    return (
        placed.withColumn("__part", partition)
        .join(F.broadcast(offsets), "__part")  # one row per partition of the sort
        .withColumn(name, F.col("__offset") + ordinal + start)
        .drop("__part", "__place", "__offset")
    )


def fill_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Column defaults: a missing value takes the declared one."""
    return df.withColumns({name: F.coalesce(F.col(name), value) for name, value in defaults.items()})
