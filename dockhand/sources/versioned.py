"""A stored table that is changed by key without rewriting all of it.

A table is a folder of Parquet files and of versions; a version is the list of
files that make up the table, with the number of the batch that made it. A
merge finds the files that hold a changed key, writes their rows anew together
with the new keys, and then adds a version: the untouched files and the new
ones. Readers take the newest finished version, so a run that fails before
leaves the table as it was, and a batch that comes again finds its number and
does nothing. Files of older versions stay until :func:`drop_unlisted` is called.

The rows are kept in ranges of the key, so changes of neighbouring keys touch
few files. Lists of files pass through the driver, as in any Spark scan; rows do not.
One writer at a time: a second one that takes the same version number fails.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = "__file"
FIRST_BATCH = -1  # of a table that was only created


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str, key: list[str]):
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), key

    # ---- versions

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def version(self) -> int:
        """Number of the newest finished version, -1 if there is none."""
        if not self._exists(f"{self.folder}/versions"):
            return -1
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/versions")
        system = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        numbers = sorted((int(s.getPath().getName()) for s in system.listStatus(top) if s.isDirectory()), reverse=True)
        return next((n for n in numbers if self._exists(f"{self.folder}/versions/{n}/_SUCCESS")), -1)

    def _listed(self, version: int) -> DataFrame:
        return self.spark.read.schema("file STRING, batch BIGINT").parquet(f"{self.folder}/versions/{version}")

    def files(self, version: int | None = None) -> list[str]:
        rows = self._listed(self.version() if version is None else version).select("file").filter("file IS NOT NULL")
        return sorted(r["file"] for r in rows.collect())

    def batch(self) -> int:
        """Number of the batch that made the newest version."""
        return self._listed(self.version()).agg(F.max("batch")).first()[0]

    def _commit(self, version: int, files: list[str], batch: int) -> None:
        rows = [(f, batch) for f in files] or [(None, batch)]
        self.spark.createDataFrame(rows, "file STRING, batch BIGINT").coalesce(1).write.mode("error").parquet(
            f"{self.folder}/versions/{version}"
        )

    def _write(self, rows: DataFrame, version: int) -> list[str]:
        """Files of the rows, in ranges of the key. A failed run's leftovers are replaced."""
        target = f"{self.folder}/data/{version}"
        rows.repartitionByRange(*self.key).sortWithinPartitions(*self.key).write.mode("overwrite").parquet(target)
        stored = self.spark.read.schema(rows.schema).parquet(target)
        return [r[FILE] for r in stored.select(F.col("_metadata.file_path").alias(FILE)).distinct().collect()]

    # ---- rows

    def create(self, rows: DataFrame) -> None:
        """Version 0 of the table. Runs jobs."""
        rows.limit(0).write.mode("overwrite").parquet(f"{self.folder}/schema")
        self._commit(0, self._write(rows, 0), FIRST_BATCH)

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, by default the newest."""
        return self._rows(self.files(version))

    def _rows(self, files: list[str]) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.folder}/schema").schema
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def touched(self, changes: DataFrame, on: list[str]) -> list[str]:
        """Files with a row of a changed key. Reads the key only."""
        rows = self.read().select(*on, F.col("_metadata.file_path").alias(FILE)) if self.files() else None
        if rows is None:
            return []
        return [r[FILE] for r in rows.join(changes.select(*on), on, "left_semi").select(FILE).distinct().collect()]

    def rewrite(
        self, changes: DataFrame, on: list[str], rule: Callable[[DataFrame, DataFrame], DataFrame], batch: int | None = None
    ) -> bool:
        """Put ``rule(old rows, changes)`` in place of the files with rows that equal a change in ``on``.

        False if the batch was applied before. Runs jobs.
        """
        if batch is not None and batch <= self.batch():
            return False
        version, touched = self.version(), self.touched(changes, on)
        old = self._rows(touched)
        kept = sorted(set(self.files(version)) - set(touched))
        written = self._write(rule(old, changes).select(*old.columns), version + 1)
        self._commit(version + 1, kept + written, FIRST_BATCH if batch is None else batch)
        return True

    def merge(self, changes: DataFrame, rule: Callable[[DataFrame], DataFrame], batch: int | None = None) -> bool:
        """Change the table by key; False if the batch was applied before. Runs jobs.

        ``rule`` gets every old row of the touched files and every change, in
        columns ``old`` and ``new`` (structs, NULL where there is none) beside
        the key, and gives the rows that take the place of the old ones. Keys
        are not NULL, and a batch holds a key once; one that was applied before is not looked at.
        """
        if batch is not None and batch <= self.batch():
            return False
        changes = changes.localCheckpoint(storageLevel=StorageLevel.DISK_ONLY)  # checked, looked up and applied; if it is lost, the batch comes again
        repeated = changes.groupBy(*self.key).count().filter("count > 1 OR " + " OR ".join(f"`{k}` IS NULL" for k in self.key))
        if not repeated.isEmpty():
            raise ValueError("a key is NULL or is changed more than once in a batch")

        def met(old: DataFrame, new: DataFrame) -> DataFrame:
            before = old.select(*self.key, F.struct(*old.columns).alias("old"))
            after = new.select(*self.key, F.struct(*new.columns).alias("new"))
            return rule(before.join(after, self.key, "full_outer"))

        return self.rewrite(changes, self.key, met, batch)

    def upsert(self, changes: DataFrame, batch: int | None = None, deleted: str | None = None) -> bool:
        """Rows of known keys are replaced, others added; where the boolean column ``deleted`` holds, rows go."""

        def rule(met: DataFrame) -> DataFrame:
            columns = [c for c in changes.columns if c != deleted]
            if deleted:
                met = met.filter(~F.coalesce(F.col(f"new.{deleted}"), F.lit(False)))
            return met.select(*(F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in columns))

        return self.merge(changes, rule, batch)

    def update(self, changes: DataFrame, batch: int | None = None) -> bool:
        """Columns of the changes replace those of known keys; other columns and unknown keys are left alone."""
        changed = [c for c in changes.columns if c not in self.key]

        def rule(met: DataFrame) -> DataFrame:
            known = met.filter(F.col("old").isNotNull())
            columns = [f.name for f in known.schema["old"].dataType.fields]
            return known.select(
                *(
                    (F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) if c in changed else F.col(f"old.{c}")).alias(c)
                    for c in columns
                )
            )

        return self.merge(changes, rule, batch)

    def drop_unlisted(self) -> int:
        """Delete data files that the newest version does not list; older versions can then not be read. Returns how many."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        top = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/data")
        system, gone = top.getFileSystem(conf), 0
        listed = {jvm.org.apache.hadoop.fs.Path(f).toUri().getPath() for f in self.files()}
        found = system.listFiles(top, True)
        while found.hasNext():
            path = found.next().getPath()
            if path.getName().endswith(".parquet") and path.toUri().getPath() not in listed:
                gone += bool(system.delete(path, False))
        return gone
