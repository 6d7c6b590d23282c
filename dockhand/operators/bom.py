"""Bill-of-material explosion, level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.session import ensure_checkpoint_dir

MAX_LEVELS = 64


def top_assemblies(components: DataFrame) -> DataFrame:
    """Parents that are not a component of anything."""
    parents = components.select(F.col("ParentPartID").alias("RootPartID")).distinct()
    children = components.select(F.col("ChildPartID").alias("RootPartID")).distinct()
    return parents.join(children, "RootPartID", "left_anti")


def explode_levels(
    components: DataFrame, roots: DataFrame | None = None, max_levels: int = MAX_LEVELS
) -> DataFrame:
    """Rows (RootPartID, PartID, Level, Quantity): quantity of a part in a root at a level.

    Runs one join per level. Paths that meet in the same part are summed
    before the next join, and every level is checkpointed, so the plan stays
    one join deep and a lost executor costs one level. Without ``roots`` every
    parent is a root. A structure deeper than ``max_levels`` is taken for a
    cycle and refused.
    """
    ensure_checkpoint_dir(components.sparkSession)
    edges = (
        components.groupBy("ParentPartID", "ChildPartID").agg(F.sum(F.col("Quantity").cast("long")).alias("Quantity"))
    ).checkpoint()
    level = edges.select(
        F.col("ParentPartID").alias("RootPartID"), F.col("ChildPartID").alias("PartID"), "Quantity"
    )
    if roots is not None:
        level = level.join(roots.select("RootPartID"), "RootPartID", "left_semi")
    level = level.withColumn("Level", F.lit(1).cast("long")).checkpoint()
    found = []
    while not level.isEmpty():
        if len(found) == max_levels:
            raise ValueError(f"more than {max_levels} levels: the part structure has a cycle")
        found.append(level)
        step = edges.withColumnsRenamed({"ParentPartID": "PartID", "Quantity": "__per"})
        level = (
            level.join(step, "PartID")
            .groupBy("RootPartID", "ChildPartID", "Level")
            .agg(F.sum(F.col("Quantity") * F.col("__per")).alias("Quantity"))
            .select("RootPartID", F.col("ChildPartID").alias("PartID"), (F.col("Level") + 1).alias("Level"), "Quantity")
            .checkpoint()
        )
    result = found[0] if found else level
    for more in found[1:]:
        result = result.unionByName(more)
    return result.select("RootPartID", "PartID", "Level", "Quantity")


def explode_bom(components: DataFrame, roots: DataFrame | None = None, max_levels: int = MAX_LEVELS) -> DataFrame:
    """Total quantity of every part in every root, and the first level it is met at."""
    return (
        explode_levels(components, roots, max_levels)
        .groupBy("RootPartID", "PartID")
        .agg(F.sum("Quantity").alias("TotalQuantity"), F.min("Level").alias("FirstLevel"))
    )


def where_used(components: DataFrame, max_levels: int = MAX_LEVELS) -> DataFrame:
    """Per part: the top assemblies it ends up in, with its total quantity there."""
    exploded = explode_bom(components, top_assemblies(components), max_levels)
    return exploded.select("PartID", F.col("RootPartID").alias("TopPartID"), "TotalQuantity")
