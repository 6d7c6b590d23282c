"""Product structure: parts per product, quantities, revisions, links, audit, updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.functions.values import json_path_text


def product_parts(parts: DataFrame, bom: DataFrame, revisions: DataFrame, changes: DataFrame) -> DataFrame:
    """Every product's parts with each revision and each change.

    Duplicates are kept: a part with r revisions and c changes gives r * c rows
    per use. What hangs on a part is joined first, so the uses take part in
    one join only; AQE broadcasts or merges by measured size, and can split a
    part used by a large share of all products because no further join relies
    on the partitioning.
    """
    described = parts.join(revisions, "PartID").join(changes, "PartID", "left")
    return bom.join(described, "PartID").select(
        "ProductID", "PartNumber", "Nomenclature", "Revision", "ChangeDescription"
    )


def get_product_parts(
    parts: DataFrame, bom: DataFrame, revisions: DataFrame, changes: DataFrame, product_id: int
) -> DataFrame:
    """Parts of one product; the filter reaches the scan of the bill of materials."""
    spark = parts.sparkSession
    return spark.sql(
        """
        SELECT p.PartNumber, p.Nomenclature, r.Revision, c.ChangeDescription
        FROM {bom} b
        JOIN {parts} p ON p.PartID = b.PartID
        JOIN {revisions} r ON r.PartID = b.PartID
        LEFT JOIN {changes} c ON c.PartID = b.PartID
        WHERE b.ProductID = :product_id
        """,
        args={"product_id": product_id},
        bom=bom,
        parts=parts,
        revisions=revisions,
        changes=changes,
    )


def product_part_quantity(bom: DataFrame, parts: DataFrame) -> DataFrame:
    """Total quantity per product and part number.

    The join keeps one narrow row per use and the sum combines before its
    shuffle.
    """
    return (
        bom.join(parts.select("PartID", "PartNumber"), "PartID")
        .groupBy("ProductID", "PartNumber")
        .agg(F.sum("Quantity").alias("TotalQuantity"))
    )


def effective_revision(lookups: DataFrame, effectivity: DataFrame, part: str, on: str) -> DataFrame:
    """Add the revision of a part valid on a date: ``UsedOn <= date < EffectiveToDate``.

    The part id is an equality, so this stays a hash or sort-merge join with
    the dates as its filter; an open end date is NULL.
    """
    e = effectivity.select(
        F.col("PartID").alias("__part"), "Revision", "UsedOn", F.col("EffectiveToDate").alias("__until")
    )
    when = F.col(on)
    valid = (when >= F.col("UsedOn")) & (F.col("__until").isNull() | (when < F.col("__until")))
    return lookups.join(e, (F.col(part) == F.col("__part")) & valid).drop("__part", "__until")


def link_documents(docs: DataFrame, parts: DataFrame, key: str, text: str, pattern: str, prefix: str = "") -> DataFrame:
    """Rows (key, PartID, PartNumber) for every part number named in a text.

    ``pattern`` finds the tokens and ``prefix`` completes them to a part
    number. Each document offers a token once.
    """
    found = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    named = docs.select(key, F.explode(found).alias("token")).select(
        key, F.concat(F.lit(prefix), F.col("token")).alias("PartNumber")
    )
    return named.join(parts.select("PartID", "PartNumber"), "PartNumber").select(key, "PartID", "PartNumber")


def audit_changes(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per inserted, updated or deleted key.

    Inserts and updates carry the new values, deletes the old ones. Rows equal
    in all columns (NULL equals NULL) give nothing.
    """
    o = old.select(F.col(key), F.struct(*columns).alias("__old"))
    n = new.select(F.col(key), F.struct(*columns).alias("__new"))
    before, after = F.col("__old"), F.col("__new")
    action = (
        F.when(before.isNull(), "INSERT").when(after.isNull(), "DELETE").when(~before.eqNullSafe(after), "UPDATE")
    )
    return (
        o.join(n, key, "full_outer")
        .withColumn("Action", action)
        .filter(F.col("Action").isNotNull())
        .select(key, F.coalesce(after, before).alias("__row"), "Action")
        .select(key, "__row.*", "Action")
    )


def add_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """A new column, NULL everywhere."""
    return df.withColumn(name, F.lit(None).cast(data_type))


def update_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """Set columns where the condition holds; other rows keep their values."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in changes.items()})


def configuration_value(products: DataFrame, path: str, out: str, column: str = "Configuration") -> DataFrame:
    """(ProductName, value at a JSON path as JSON text)."""
    return products.select("ProductName", json_path_text(F.col(column), path).alias(out))
