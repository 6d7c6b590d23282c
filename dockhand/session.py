"""Session defaults, checkpoint folder and scan spreading."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library expects. Shuffle partitions are left to
# the cluster: AQE coalesces small ones and splits skewed ones.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "dockhand", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; ``conf`` overrides (``_`` stands for ``.``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SESSION_DEFAULTS | {k.replace("_", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder: the one the cluster names, else a test folder.

    ``spark.checkpoint.dir`` wins. Only a local session may fall back to a
    temporary folder; on a cluster a missing setting is an error, because
    executors on other machines could not read a machine-local folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="dockhand-checkpoint-")
    context.setCheckpointDir(named)
    return named


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan of fewer splits than cores over all cores by a unique key.

    A large table yields more splits than cores and passes through untouched,
    so no shuffle is added where it would cost anything. Hashing on a key
    keeps a re-run task's output the same without the extra sort of a
    round-robin repartition.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
