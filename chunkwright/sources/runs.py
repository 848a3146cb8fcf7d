"""Result tables of a workspace, one folder per run.

A run writes its tables below ``<table>/run=<n>``, the chunks it asked for below ``asked/run=<n>``,
and last one row below ``commits/run=<n>``.  Runs without that row do not count; their number is
used again.  Of a chunk asked for in several runs only the latest one's rows are current.  A fresh
run starts over: earlier ones no longer count.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.sources.jsonl import read_lines, write_jsonl

# Where the records of each table name their chunk.
CHUNK_OF = {
    "generations": "$.metadata.chunk_id",
    "verified": "$.metadata.chunk_id",
    "rejected": "$.item.metadata.chunk_id",
    "failed_chunks": "$.chunk_id",
    "failed_replies": "$.reply.chunk_id",
}


def committed_runs(spark: SparkSession, workspace: str) -> list[int]:
    """Numbers of the runs that count, ascending: one per run since the last fresh one."""
    commits = spark.read.option("recursiveFileLookup", "true").schema("run BIGINT, fresh BOOLEAN")
    try:
        rows = commits.json(f"{workspace}/commits").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    start = max((r.run for r in rows if r.fresh), default=0)
    return sorted(r.run for r in rows if r.run >= start)


def commit_run(asked: DataFrame, tables: dict[str, DataFrame], workspace: str, fresh: bool) -> int:
    """Write the tables of a run over the chunks ``asked`` (``chunk_id``), then its commit row."""
    spark = asked.sparkSession
    run = max(committed_runs(spark, workspace), default=0) + 1
    for name, rows in {"asked": asked.select("chunk_id"), **tables}.items():
        write_jsonl(rows, f"{workspace}/{name}/run={run}")
    row = spark.range(1).select(F.lit(run).cast("bigint").alias("run"), F.lit(fresh).alias("fresh"))
    write_jsonl(row.coalesce(1), f"{workspace}/commits/run={run}")
    return run


def superseded(spark: SparkSession, workspace: str, runs: list[int]) -> DataFrame:
    """``chunk_id, run`` of chunks that a later run asked for again."""
    paths = [f"{workspace}/asked/run={r}" for r in runs]
    asked = spark.read.schema("chunk_id STRING").json(paths).select("chunk_id", _run().alias("run")).distinct()
    again = asked.groupBy("chunk_id").agg(F.max("run").alias("last"))
    return asked.join(again, "chunk_id").where("run < last").select("chunk_id", "run")


def current_lines(spark: SparkSession, workspace: str, table: str) -> DataFrame:
    """Current records of a result table as JSON lines ``(file, value)``."""
    runs = committed_runs(spark, workspace)
    if not runs:
        return spark.createDataFrame([], "file string, value string")
    lines = read_lines(spark, *[f"{workspace}/{table}/run={r}" for r in runs])
    if len(runs) == 1:
        return lines
    keyed = lines.select("*", F.get_json_object("value", CHUNK_OF[table]).alias("chunk_id"), _run("file").alias("run"))
    return keyed.join(superseded(spark, workspace, runs), ["chunk_id", "run"], "left_anti").select("file", "value")


def _run(path: str = "_metadata.file_path"):
    return F.regexp_extract(path, r"/run=(\d+)/[^/]*$", 1).cast("bigint")
