"""Levels and cycles of a part structure, by peeling and label propagation.

Peeling takes away, round by round, the parts that have no open parent, with
their edges; the round gives a part's level, the longest way from a top. What
is left when no part is free hangs on cycles; taking away the parts without
open children leaves the cores. A core falls into cycles (strongly connected
parts) by colours: every part takes the largest name that reaches it, and the
parts of a colour that lead back to the part of that name are one cycle; the
others go into the next round. Edges and labels are checkpointed in every
round, so a round is a join deep and a lost executor costs one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.operators.bom import explode_bom
from dockhand.session import ensure_checkpoint_dir

EDGE = ["ParentPartID", "ChildPartID"]


def _edges(components: DataFrame) -> DataFrame:
    """Every edge once; a NULL end is no edge."""
    ensure_checkpoint_dir(components.sparkSession)
    return components.select(*EDGE).filter("ParentPartID IS NOT NULL AND ChildPartID IS NOT NULL").distinct().checkpoint()


def _without_free(edges: DataFrame, end: str, other: str) -> tuple[DataFrame, DataFrame]:
    """(free parts, edges left): a part is free if it stands at ``end`` of an edge and at the ``other`` end of none."""
    free = edges.select(end).distinct().join(edges.select(F.col(other).alias(end)).distinct(), end, "left_anti").checkpoint()
    return free, edges.join(free, end, "left_anti").checkpoint()


def peeled(components: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(levels, open edges): PartID and Level of every part above which there is no cycle, and the edges left over. Runs jobs."""
    edges = _edges(components)
    spark, gone, rounds = components.sparkSession, [], 0
    while True:
        free, left = _without_free(edges, *EDGE)
        if free.isEmpty():
            break
        if not rounds:
            gone.append(free.select(F.col("ParentPartID").alias("PartID"), F.lit(0).cast("long").alias("Level")))
        rounds += 1
        below = edges.join(free, "ParentPartID", "left_semi")
        gone.append(below.select(F.col("ChildPartID").alias("PartID"), F.lit(rounds).cast("long").alias("Level")).distinct())
        edges = left
    if not gone:
        kind = edges.schema["ParentPartID"].dataType.simpleString()
        return spark.createDataFrame([], f"PartID {kind}, Level long"), edges
    found = gone[0]
    for more in gone[1:]:
        found = found.unionByName(more)
    levels = found.groupBy("PartID").agg(F.max("Level").alias("Level"))
    return levels.join(edges.select(F.col("ChildPartID").alias("PartID")).distinct(), "PartID", "left_anti"), edges


def part_levels(components: DataFrame) -> DataFrame:
    """(PartID, Level): the longest way down to a part, 0 for tops; parts on or below a cycle are left out. Runs jobs."""
    return peeled(components)[0]


def _spread(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(PartID, Label) where each part takes the largest label that reaches it along the edges. Runs a job a step."""
    while True:
        came = edges.join(labels.withColumnRenamed("PartID", "ParentPartID"), "ParentPartID").select(F.col("ChildPartID").alias("PartID"), "Label", F.lit(False).alias("own"))
        met = labels.withColumn("own", F.lit(True)).unionByName(came).groupBy("PartID")
        grown = met.agg(F.max("Label").alias("Label"), F.max(F.when(F.col("own"), F.col("Label"))).alias("before")).checkpoint()
        labels = grown.select("PartID", "Label")
        if grown.filter("Label > before").isEmpty():
            return labels


def bom_cycles(components: DataFrame) -> DataFrame:
    """(CycleID, PartID, Parts): the parts of every cycle, named by its smallest part. Runs jobs.

    Cycles that share a part are one. A part that contains itself is a cycle of one part.
    """
    edges = peeled(components)[1]
    while True:
        free, left = _without_free(edges, "ChildPartID", "ParentPartID")
        if free.isEmpty():
            break
        edges = left
    found = []
    itself = edges.filter("ParentPartID = ChildPartID").select(F.col("ParentPartID").alias("PartID"))
    while not edges.isEmpty():
        parts = edges.select(F.explode(F.array(*EDGE)).alias("PartID")).distinct()
        colours = _spread(parts.withColumn("Label", F.col("PartID")), edges)
        ends = colours.select(F.col("PartID").alias("ParentPartID"), F.col("Label").alias("from_label"))
        inside = edges.join(ends, "ParentPartID").join(colours.withColumnsRenamed({"PartID": "ChildPartID", "Label": "to_label"}), "ChildPartID")
        inside = inside.filter("from_label = to_label").select("ParentPartID", "ChildPartID", F.col("from_label").alias("Label")).checkpoint()
        back = colours.filter("PartID = Label").select("PartID", "Label").checkpoint()
        reached = back
        while not back.isEmpty():  # against the edges, within the colour
            step = inside.join(back.withColumnRenamed("PartID", "ChildPartID"), ["ChildPartID", "Label"]).select(F.col("ParentPartID").alias("PartID"), "Label")
            back = step.distinct().join(reached, ["PartID", "Label"], "left_anti").checkpoint()
            reached = reached.unionByName(back).checkpoint()
        found.append(reached)
        rest = parts.join(reached.select("PartID"), "PartID", "left_anti")
        for end in EDGE:
            edges = edges.join(rest.withColumnRenamed("PartID", end), end, "left_semi")
        edges = edges.checkpoint()
    if not found:
        kind = components.schema["ParentPartID"].dataType.simpleString()
        return components.sparkSession.createDataFrame([], f"CycleID {kind}, PartID {kind}, Parts long")
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    facts = together.groupBy("Label").agg(F.min("PartID").alias("CycleID"), F.count(F.lit(1)).alias("Parts"))
    alone = itself.distinct().withColumn("alone", F.lit(True))
    named = together.join(facts, "Label").join(alone, "PartID", "left")
    return named.filter("Parts > 1 OR alone").select("CycleID", "PartID", "Parts")


def explode_acyclic(components: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(quantities, cycles): the explosion of the structure without the parts of cycles, and these parts. Runs jobs.

    The number of levels is known from peeling before the first join.
    """
    cycles = bom_cycles(components).checkpoint()
    rest = components
    for end in EDGE:
        rest = rest.join(cycles.select(F.col("PartID").alias(end)), end, "left_anti")
    rest = rest.select(*components.columns)
    deepest = part_levels(rest).agg(F.max("Level")).first()[0] or 0
    return explode_bom(rest, max_levels=deepest), cycles
