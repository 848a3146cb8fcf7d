"""Session settings and the physical helpers the stages share."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Run-time settings that results depend on.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Replies may repeat a key; the last one wins, as in common JSON readers.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def get_spark(cores: str = "*", memory: str = "16g") -> SparkSession:
    """A local session with the settings used for tests and benchmarks."""
    return configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("chunkwright")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording a call site per expression costs more than building the plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan at least one partition per core before costly per-row work.

    A large table has more splits than cores already and is left alone; only a scan
    of a few small files is redistributed.  Call it on plain scans: counting the
    partitions of a plan that shuffles would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores, *keys)


def once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that are computed exactly once per row, however often they are used.

    Spark copies the expression of a projected column into the filters and projections
    that use it.  For a costly one (a parse, a fold) that repeats the work and swells the
    plan.  Expressions are not copied across a generator, so the columns pass through one
    that yields a single row.  They are computed in a projection below it, which Spark compiles; the generator's
    own expressions it would interpret.  Bind a struct column with ``let`` before reading its fields
    here: Spark may otherwise prune the column below the generator and lose it above.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return unpacked(df.select(*[c for c in df.columns if c not in columns], row.alias("_once")), "_once")


def unpacked(df: DataFrame, row: str) -> DataFrame:
    """The fields of a struct column, which is computed exactly once, as columns in its place."""
    return df.select(*[c for c in df.columns if c != row], F.inline_outer(F.array(row)))


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates, as named by ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    # Unset, as in some local sessions: the warehouse is a folder that all executors share too.
    root = root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/intermediates"
    return root.rstrip("/")


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A result written once as parquet in the shared folder, and its path."""
    path = f"{checkpoint_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stored results that nothing will read again."""
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write a result once as parquet in the shared folder and go on from the files.

    Used where a plan must not be run twice (model replies) or is costly and feeds
    several sinks.  The files outlive lost executors and keep column pruning.
    """
    return stored(df, name)[0]
