"""Small helpers the operators of this folder share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.session import ensure_checkpoint_dir

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# The columns of documents, which every stage of the pipeline but the last returns.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; Python workers will find this library where the driver found it."""
    context, home = spark.sparkContext, str(Path(__file__).resolve().parents[2])
    path = context.environment.get("PYTHONPATH", "")
    if home not in path.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [path, home]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: a reliable checkpoint in the folder that all executors share."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Cut lineage by a compressed table in the shared folder, for rows that are large."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/dockhand-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def many(df: DataFrame) -> int:
    """Number of shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def arrow(schema: str) -> pa.Schema:
    """Arrow schema of a short ``name type, ...`` text."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
        "double": pa.float64(), "boolean": pa.bool_(), "float": pa.float32(),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(","))])


def batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows as one Arrow batch, none if there are no rows."""
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
        )


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5
