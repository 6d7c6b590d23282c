"""Dense surrogate keys for a table that grows by batches.

A batch reserves the keys after the highest one reserved so far, before its
rows are written, under its own number. A run that stops in between and comes
again finds its reservation and gives the same rows the same keys; a batch that
was stored does nothing. Earlier rows are never read or written again: the
highest key comes from the reservations, one row for each batch.

Inside a batch the keys follow ``order``; rows that tie there follow their
whole content, so only rows equal in every column are interchangeable.
One writer at a time: a second one that reserves under the same number fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockhand.operators.numbering import surrogate_keys

RESERVATION = "batch BIGINT, first BIGINT, held BIGINT"


class KeyedTable:
    """Rows under ``folder`` with a key column ``name`` of the numbers from ``start`` on, without gaps."""

    def __init__(self, spark: SparkSession, folder: str, name: str, start: int = 1):
        self.spark, self.folder, self.name, self.start = spark, folder.rstrip("/"), name, start

    def _finished(self, part: str) -> list[str]:
        """Folders of ``part`` that were written to their end, one for each batch."""
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{part}")
        system = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(top):
            return []
        folders = [s.getPath() for s in system.listStatus(top) if s.isDirectory()]
        return sorted(f.toString() for f in folders if system.exists(jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))

    def reservations(self) -> DataFrame:
        """(batch, first, held): the first key of each batch and how many it holds."""
        folders = self._finished("reservations")
        return self.spark.read.schema(RESERVATION).parquet(*folders) if folders else self.spark.createDataFrame([], RESERVATION)

    def read(self) -> DataFrame | None:
        """The rows of all stored batches; None before the first."""
        folders = self._finished("rows")
        return self.spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None

    def append(self, rows: DataFrame, order: list[Column | str], batch: int) -> bool:
        """Store the rows of a batch with their keys; False if the batch is stored already. Runs jobs.

        Raises ``ValueError`` if the rows have a column of the key's name, or if a batch that was reserved comes
        again with another number of rows.
        """
        if self.name in rows.columns:
            raise ValueError(f"the rows have a column {self.name}")
        target = f"{self.folder}/rows/{batch}"
        if any(f.rsplit("/", 1)[1] == str(batch) for f in self._finished("rows")):
            return False
        known = self.reservations().agg(
            F.max(F.when(F.col("batch") == batch, F.struct("first", "held"))).alias("own"), F.max(F.col("first") + F.col("held")).alias("next")
        ).first()
        first = known.own.first if known.own else known.next if known.next is not None else self.start
        content = F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns)), {"ignoreNullFields": "false"})
        keyed = surrogate_keys(rows, [*order, content], self.name, first)
        held = keyed.count()
        if known.own and known.own.held != held:
            raise ValueError(f"batch {batch} reserved {known.own.held} keys and now has {held} rows")
        if not known.own:
            reservation = self.spark.createDataFrame([(batch, first, held)], RESERVATION).coalesce(1)
            reservation.write.mode("error").parquet(f"{self.folder}/reservations/{batch}")
        keyed.write.mode("overwrite").parquet(target)  # leftovers of a run that failed are replaced
        return True


def start_keyed_append(stream: DataFrame, table: KeyedTable, order: list[Column | str], checkpoint_dir: str) -> StreamingQuery:
    """Append the micro-batches of a stream; one that is replayed keeps its keys."""

    def store(rows: DataFrame, batch_id: int) -> None:
        table.append(rows, order, batch_id)

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
