from __future__ import annotations

import __spark_entry__ as entry
from pyspark.sql import functions as F

from dockhand.operators import dedup, manifests, products, quality


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"file_id", "content", "language", "keywords", "route"} <= set(df.columns)


def test_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own = set(entry.queries()) - set(entry.MORE_QUERIES)
    assert own - set(entry.oracle_sql()) == {"scan_landing", "file_metadata_json", "encrypt_landing"}


def test_a_third_of_all_rows_on_one_key(spark):
    """Hot keys give the same results as every other key, with and without broadcasts."""
    rows = spark.range(30_000).withColumn("k", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500))
    bom = rows.select(F.col("id").alias("ProductID"), F.col("k").alias("PartID"), F.lit(2).cast("long").alias("Quantity"))
    parts = rows.select(F.col("k").alias("PartID")).distinct().filter("PartID <> 7").withColumn("PartNumber", F.concat(F.lit("PN-"), "PartID"))
    want = rows.filter("k <> 7").count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            total = products.product_part_quantity(bom, parts)
            assert tuple(total.agg(F.count(F.lit(1)), F.sum("TotalQuantity")).first()) == (want, 2 * want)
            lost = quality.orphans(bom, "bom", "PartID", parts, "PartID").collect()
            assert [(r.key_value, r.n_rows) for r in lost] == [("7", 30_000 - want)]
            newest = manifests.latest_by_key(rows, ["k"], [F.desc("id")])
            assert {r.k: r.id for r in newest.collect()}[-1] == 29_997  # the last multiple of three
            files = rows.select(F.format_string("/s/%08d", "id").alias("path"), F.col("k").cast("string").alias("content"))
            registry = dedup.content_hashes(files.filter("content = '3'")).select("sha256").distinct()
            new = dedup.new_registry_rows(files, registry)
            assert new.count() == rows.select("k").distinct().count() - 1
            assert not new.filter("filename = '00000000'").isEmpty()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
