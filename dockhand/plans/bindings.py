"""The library's input shapes derived from the supplied test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockhand.operators.manifests import latest_by_key
from dockhand.session import spread

AS_OF = "2024-03-01 00:00:00"


def as_of():
    """The fixed point in time every gated query uses instead of the clock."""
    return F.lit(AS_OF).cast("timestamp_ntz")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "pages"), "page_id")


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Chat turns as log lines."""
    turns = spread(table(spark, folder, "conversations"), "conv_id", "turn")
    return turns.select("conv_id", "turn", F.concat_ws(" ", "role", "text").alias("line"))


def files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as landed files."""
    kind = F.col("doc_id") % 5
    extension = F.when(kind == 0, ".HTML").when(kind == 1, ".bin").otherwise(".txt")
    return documents(spark, folder).select(
        F.col("doc_id").alias("file_id"),
        F.concat(F.lit("/staging/"), "source", F.lit("/doc_"), F.col("doc_id").cast("string"), extension).alias("path"),
        F.col("text").alias("content"),
        F.octet_length("text").cast("long").alias("size"),
        "lang",
        "source",
        (F.col("doc_id") % 60).alias("age_days"),
    )


def parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("PartID"),
        F.concat(F.lit("PN-"), F.col("p_partkey").cast("string")).alias("PartNumber"),
        F.col("p_name").alias("Nomenclature"),
        F.col("p_size").cast("decimal(10,2)").alias("Mass"),
        F.col("p_brand").alias("CreatedBy"),
    )


def bom(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ProductID"),
        F.col("l_partkey").alias("PartID"),
        F.col("l_quantity").cast("long").alias("Quantity"),
    )


def part_revisions(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .select(F.col("l_partkey").alias("PartID"), F.col("l_returnflag").alias("Revision"))
        .distinct()
    )


def change_management(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "part")
        .filter("p_size > 25")
        .select(F.col("p_partkey").alias("PartID"), F.concat(F.lit("change "), "p_type").alias("ChangeDescription"))
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ProductID"),
        F.col("o_orderpriority").alias("ProductName"),
        F.concat(F.lit('{"color": "'), "o_orderpriority", F.lit('"}')).alias("Configuration"),
    )


def part_components(spark: SparkSession, folder: str) -> DataFrame:
    """A tree over the parts: root 0, five components per parent."""
    return (
        table(spark, folder, "part")
        .filter("p_partkey > 0")
        .select(
            F.floor(F.col("p_partkey") / 5).cast("long").alias("ParentPartID"),
            F.col("p_partkey").alias("ChildPartID"),
            (1 + F.col("p_size") % 3).cast("long").alias("Quantity"),
        )
    )


def revision_effectivity(spark: SparkSession, folder: str) -> DataFrame:
    """A revision is valid from its first use to the next revision's first use."""
    first_use = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_partkey").alias("PartID"), F.col("l_returnflag").alias("Revision"))
        .agg(F.min("l_shipdate").cast("date").alias("UsedOn"))
    )
    following = Window.partitionBy("PartID").orderBy("UsedOn", "Revision")
    return first_use.withColumn("EffectiveToDate", F.lead("UsedOn").over(following))


def _new_year(year: int):
    return F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")


def parts_snapshot(spark: SparkSession, folder: str, year: int) -> DataFrame:
    """The parts in use in a year, with the heaviest use as their mass.

    Two years give the two states of the parts table that the audit compares.
    """
    use = (
        table(spark, folder, "lineitem")
        .filter((F.col("l_shipdate") >= _new_year(year)) & (F.col("l_shipdate") < _new_year(year + 1)))
        .groupBy(F.col("l_partkey").alias("PartID"))
        .agg(F.max("l_quantity").cast("decimal(10,2)").alias("Mass"))
    )
    return parts(spark, folder).drop("Mass").join(use, "PartID").select(
        "PartID", "PartNumber", "Nomenclature", "Mass", "CreatedBy"
    )


def monitor_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as the attempt log."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("FileID"),
        "ts",
        F.when(kind == "error", "Failed")
        .when(kind == "signup", "Processing")
        .when(kind == "click", "Retried")
        .otherwise("Completed")
        .alias("Status"),
        F.when(kind.isin("view", "purchase"), F.col("value")).alias("DurationSeconds"),
        F.when(kind.isin("error", "click"), F.concat(F.lit("code "), "props")).alias("ErrorLog"),
    )


def monitor(spark: SparkSession, folder: str) -> DataFrame:
    """Current status per file."""
    newest = latest_by_key(monitor_events(spark, folder), ["FileID"], [F.desc("ts"), F.desc("event_id")])
    return newest.select("FileID", "Status", "DurationSeconds", "ErrorLog", F.col("ts").alias("ProcessedAt"))


def landing_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The attempt log with one file per user and day: short histories, some of failures only."""
    log = monitor_events(spark, folder)
    return log.withColumn("FileID", F.col("FileID") * 100 + F.dayofmonth("ts"))


def landed_path(file_id):
    """Path of a file of the attempt log."""
    return F.concat(F.lit("/staging/file_"), file_id.cast("string"), F.lit(".txt"))
