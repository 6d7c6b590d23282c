from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from dockhand.operators import dedup, monitor, products
from dockhand.operators.language import train_profile
from dockhand.plans import bindings as b
from dockhand.plans.documents import process_documents
from dockhand.sources import landing, logs, tables
from dockhand.streaming import intake, live


@pytest.fixture
def landing_dir(spark, small, tmp_path):
    """A hundred documents as files, with a copy, an empty and a blank file and a subfolder."""
    folder = tmp_path / "landing"
    (folder / "sub").mkdir(parents=True)
    for row in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").limit(100).collect():
        (folder / f"doc_{row.doc_id}.txt").write_text(row.text)
    shutil.copy(folder / "doc_0.txt", folder / "doc_0_copy.txt")
    (folder / "page.html").write_text("<html><title>t</title><p>Hello the world of files</p></html>")
    (folder / "empty.txt").write_text("")
    (folder / "blank.txt").write_text(" \n")
    (folder / "sub" / "deep.txt").write_text("not seen")
    return folder


def stamp():
    return F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")


def rows(df, *drop):
    df = df.drop(*drop)
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


def test_intake_equals_batch_and_resumes(spark, small, landing_dir, tmp_path):
    profile = train_profile(spark.read.parquet(f"{small}/documents.parquet"))
    out, failed, check = (str(tmp_path / n) for n in ("out", "failed", "check"))

    def run():
        query = intake.start_document_intake(
            spark, str(landing_dir), out, failed, check, profile, max_files_per_trigger=40, processed_at=stamp()
        )
        query.awaitTermination()

    run()
    intake.record_empty_files(spark, str(landing_dir), failed)
    intake.record_empty_files(spark, str(landing_dir), failed)
    files = intake.landed_documents(landing.scan_landing(spark, str(landing_dir)))
    batch = process_documents(files, profile, stamp())
    want = rows(batch.filter("reason IS NULL"), "reason", "route")
    assert rows(spark.read.parquet(out), "batch_id") == want
    assert len(want) == 102
    assert sorted((r.path.rsplit("/", 1)[1], r.reason) for r in spark.read.parquet(failed).collect()) == [
        ("blank.txt", "blank"),
        ("empty.txt", "empty"),
    ]
    run()  # nothing new: nothing added
    assert rows(spark.read.parquet(out), "batch_id") == want
    (landing_dir / "late.txt").write_text("one more file for the stream")
    run()
    assert spark.read.parquet(out).count() == len(want) + 1


def test_registry_stream(spark, landing_dir, tmp_path):
    registry, check = str(tmp_path / "registry"), str(tmp_path / "check")
    for _ in range(2):
        intake.start_registry_intake(spark, str(landing_dir), registry, check, max_files_per_trigger=30).awaitTermination()
    got = spark.read.parquet(registry)
    files = landing.scan_landing(spark, str(landing_dir))
    want = dedup.new_registry_rows(files, got.select("sha256").limit(0))
    assert got.count() == got.select("sha256").distinct().count()
    assert rows(got.select("sha256")) == rows(want.select("sha256"))


def test_distinct_content_stream(spark, landing_dir, tmp_path):
    stream = intake.distinct_content(landing.stream_landing(spark, str(landing_dir)))
    out = str(tmp_path / "distinct")
    query = (
        stream.select("path", "sha256").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    want = landing.scan_landing(spark, str(landing_dir)).select(F.sha2("content", 256)).distinct().count()
    assert spark.read.parquet(out).count() == want


def test_archive_moves_with_the_next_batch(spark, small, landing_dir, tmp_path):
    profile = train_profile(spark.read.parquet(f"{small}/documents.parquet"))
    archive = tmp_path / "archive"

    def run():
        intake.start_document_intake(
            spark, str(landing_dir), str(tmp_path / "o"), str(tmp_path / "f"), str(tmp_path / "c"), profile, archive_dir=str(archive)
        ).awaitTermination()

    run()
    (landing_dir / "late.txt").write_text("one more file for the stream")
    run()
    assert len([p for p in archive.rglob("*.txt")]) >= 100
    assert not (landing_dir / "doc_0.txt").exists()


def test_live_metrics_equal_batch(spark, checked, tmp_path):
    log = b.monitor_events(spark, checked)
    folder = str(tmp_path / "log")
    log.repartition(4).write.parquet(folder)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    live.start_live_metrics(stream, "live_metrics", str(tmp_path / "c")).awaitTermination()
    assert spark.table("live_metrics").collect() == monitor.processing_metrics(log).collect()


def test_running_quantity_equals_batch(spark, checked, tmp_path):
    bom, parts = b.bom(spark, checked), b.parts(spark, checked)
    folder, out = str(tmp_path / "bom"), str(tmp_path / "out")
    bom.repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(bom.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    live.start_product_part_quantity(stream, parts, out, str(tmp_path / "c")).awaitTermination()
    got = live.current_product_part_quantity(spark.read.parquet(out))
    want = products.product_part_quantity(bom, parts)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_scan_and_encrypt_landing(spark, landing_dir):
    files = landing.scan_landing(spark, str(landing_dir))
    empty = landing.empty_files(spark, [str(landing_dir)])
    assert files.schema == empty.schema
    assert [(r.path, r.length) for r in empty.collect()] == [(f"file:{landing_dir}/empty.txt", 0)]
    assert files.count() == 103
    metadata = landing.file_metadata_json(files)
    assert "content" not in metadata._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert metadata.filter("filename = 'blank.txt'").first().metadata.startswith('{"filename":"blank.txt","size":2,"modified":"')
    encrypted = landing.encrypt_files(files, F.lit("0123456789abcdef"))
    joined = encrypted.join(files, "path")
    from dockhand.functions.crypto import decrypt_bytes

    assert joined.filter(decrypt_bytes(F.col("enc_content"), F.lit("0123456789abcdef")) != F.col("content")).isEmpty()
    assert joined.filter(F.col("enc_content") == F.col("content")).isEmpty()


def test_log_round_trip(spark, tmp_path):
    source = tmp_path / "app.log"
    source.write_text("".join(f"{i} from 10.0.0.{i % 10}\n" for i in range(500)))
    lines = logs.read_log(spark, str(source)).withColumn("n", F.split("value", " ")[0].cast("int"))
    name = spark.range(1).select(logs.sanitized_name(F.lit("/x/app.log"), stamp())).first()[0]
    assert name == "/x/app_Sanitized_2024-03-01_00-00-00.log"
    out = str(tmp_path / "app_Sanitized.log")
    logs.write_sanitized(lines, out, order="n")
    written = [r.value for r in spark.read.text(out).collect()]
    assert sorted(written, key=lambda v: int(v.split()[0])) == [f"{i} from xx.x.x.x" for i in range(500)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, manifest string")
    tables.append_table(df, "sink_test")
    tables.append_table(df.select("manifest", "id"), "sink_test")
    assert tables.scan_table(spark, "sink_test").count() == 4
    assert tables.preview(df, ["id"], 1).first().id == 1
    tables.write_json_documents(df, str(tmp_path / "json"), compression="gzip")
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    tables.write_package(df, str(tmp_path / "pkg"))
    assert list((tmp_path / "pkg").glob("*.gz"))
    tables.append_manifest(df.select(F.col("manifest").alias("line")), str(tmp_path / "manifest"))
    tables.append_manifest(df.select(F.col("manifest").alias("line")), str(tmp_path / "manifest"))
    assert spark.read.text(str(tmp_path / "manifest")).count() == 4
