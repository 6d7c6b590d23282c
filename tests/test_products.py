from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dockhand import schemas
from dockhand.operators import bom, dedup, intake, products, quality


def test_bom_against_brute_force(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(0, child), child, rng.randrange(1, 4)) for child in range(1, 60) for _ in range(2)]
    df = spark.createDataFrame(edges, "ParentPartID bigint, ChildPartID bigint, Quantity bigint")
    children = defaultdict(list)
    for parent, child, q in edges:
        children[parent].append((child, q))
    want = defaultdict(int)

    def walk(root, part, quantity):
        for child, q in children[part]:
            want[root, child] += quantity * q
            walk(root, child, quantity * q)

    for root in list(children):
        walk(root, root, 1)
    got = {(r.RootPartID, r.PartID): r.TotalQuantity for r in bom.explode_bom(df).collect()}
    assert got == dict(want)
    tops = {p for p, _, _ in edges} - {c for _, c, _ in edges}
    used = {(r.TopPartID, r.PartID): r.TotalQuantity for r in bom.where_used(df).collect()}
    assert used == {k: v for k, v in want.items() if k[0] in tops}


def test_bom_of_nothing_and_cycle(spark):
    schema = "ParentPartID bigint, ChildPartID bigint, Quantity bigint"
    assert bom.explode_bom(spark.createDataFrame([], schema)).isEmpty()
    with pytest.raises(ValueError, match="cycle"):
        bom.explode_bom(spark.createDataFrame([(1, 2, 1), (2, 1, 1)], schema), max_levels=5)


def test_audit(spark):
    schema = "PartID bigint, Mass double, Name string"
    old = spark.createDataFrame([(1, 1.0, "a"), (2, None, "b"), (3, 3.0, "c"), (4, None, None)], schema)
    new = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (4, None, None), (5, 5.0, "e")], schema)
    got = sorted(tuple(r) for r in products.audit_changes(old, new, "PartID", ["Mass", "Name"]).collect())
    assert got == [(2, 2.0, "b", "UPDATE"), (3, 3.0, "c", "DELETE"), (5, 5.0, "e", "INSERT")]


def test_effective_revision_bounds(spark):
    eff = spark.sql(
        "SELECT * FROM VALUES (1, 'A', DATE '2024-01-01', DATE '2024-02-01'), (1, 'B', DATE '2024-02-01', NULL) "
        "AS t(PartID, Revision, UsedOn, EffectiveToDate)"
    )
    uses = spark.sql("SELECT * FROM VALUES (1, DATE '2023-12-31'), (1, DATE '2024-01-31'), (1, DATE '2024-02-01') AS t(p, d)")
    got = sorted((str(r.d), r.Revision) for r in products.effective_revision(uses, eff, "p", "d").collect())
    assert got == [("2024-01-31", "A"), ("2024-02-01", "B")]


def test_duplicates_are_kept_in_product_parts(spark):
    parts = spark.sql("SELECT 1L AS PartID, 'PN-1' AS PartNumber, 'n' AS Nomenclature")
    uses = spark.sql("SELECT * FROM VALUES (9L, 1L, 1L), (9L, 1L, 1L), (8L, 1L, 1L) AS t(ProductID, PartID, Quantity)")
    revisions = spark.sql("SELECT 1L AS PartID, explode(array('A','B')) AS Revision")
    changes = spark.sql("SELECT 1L AS PartID, explode(array('c','d')) AS ChangeDescription")
    assert products.product_parts(parts, uses, revisions, changes).count() == 12
    assert products.get_product_parts(parts, uses, revisions, changes, 9).count() == 8
    assert products.get_product_parts(parts, uses, revisions, changes.limit(0), 8).count() == 2


def test_updates(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    got = products.update_where(df, F.col("id") == 2, {"v": F.lit("z")}).collect()
    assert [tuple(r) for r in got] == [(1, "a"), (2, "z")]
    assert products.add_column(df, "w", "decimal(10,2)").schema["w"].dataType.simpleString() == "decimal(10,2)"


def test_quality_rules(spark):
    t = spark.createDataFrame([(1, 1), (0, 1), (None, 7), (0, None)], "q int, k int")
    parent = spark.createDataFrame([(1,)], "k int")

    def rows(df):
        return sorted((r.key_value or "", r.n_rows) for r in df.collect())

    assert rows(quality.positive(t, "t", "q")) == [("0", 2)]
    assert rows(quality.not_null(t, "t", "q")) == [("", 1)]
    assert rows(quality.not_null(parent, "p", "k")) == []
    assert rows(quality.unique(t, "t", "k")) == [("1", 2)]
    assert rows(quality.orphans(t, "t", "k", parent, "k")) == [("7", 1)]


def test_declared_rules_run_over_the_catalogue(spark):
    tables = {name: spark.createDataFrame([], schemas.schema(name)) for name in schemas.TABLES}
    assert quality.report(schemas.RULES, tables).isEmpty()
    assert len(schemas.RULES) == 9 + 5 + 15 + 3


def test_create_tables(spark):
    schemas.create_tables(spark, "plm_test")
    names = {t.name for t in spark.catalog.listTables("plm_test")}
    assert names == {name.lower() for name in schemas.TABLES}
    schemas.create_tables(spark, "plm_test")


def test_dedup_first_wins_and_registry(spark):
    files = spark.createDataFrame([("/s/b", "x"), ("/s/a", "x"), ("/s/c", "y"), ("/s/d", "z")], "path string, content string")
    registry = dedup.content_hashes(files.filter("path = '/s/d'")).select("sha256")
    got = sorted(r.filename for r in dedup.new_registry_rows(files, registry).collect())
    assert got == ["a", "c"]


def test_validation_order(spark):
    df = spark.createDataFrame([(None, None), ("", 0), (None, 5), (" \n", 2), ("a", 1)], "content string, size bigint")
    assert [r.reason for r in intake.validate_files(df).collect()] == ["missing", "empty", "no_content", "blank", None]


def test_hidden_names(spark):
    df = spark.createDataFrame([("/s/.hidden",), ("/s/_under",), ("/s/plain",)], "path string")
    assert [r.path for r in intake.drop_hidden(df).collect()] == ["/s/_under", "/s/plain"]


def test_retention_bounds(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('kept', TIMESTAMP_NTZ '2024-01-31 00:00:00'), ('old', TIMESTAMP_NTZ '2024-01-30 23:59:59') AS t(name, modified)"
    )
    now = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    assert [r.name for r in intake.expired(df, now).collect()] == ["old"]
    assert [r.name for r in intake.retained(df, now).collect()] == ["kept"]


def test_fallback_only_without_a_result(spark):
    df = spark.createDataFrame([("a", "o"), ("", "o"), (None, "o"), (None, None)], "p string, f string")
    got = [(r.content, r.extraction_method) for r in intake.extract_with_fallback(df, "p", "f").collect()]
    assert got == [("a", "tika"), ("", "tika"), ("o", "tesseract"), (None, "tesseract")]
