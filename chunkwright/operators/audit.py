"""Audit of chunk files before generation starts.

Input rows are ``(file, value)`` JSON lines, or ``(file, line, value)`` where messages
should name the line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.functions.jsonfix import parse_strict
from chunkwright.functions.rules import variant_errors
from chunkwright.operators.validation import RULES
from chunkwright.session import once


def audit_lines(lines: DataFrame) -> DataFrame:
    """Add ``parsed``, ``errors``, ``valid`` and the record's ``project``."""
    record = once(lines, {"_record": parse_strict(F.col("value"))})
    errors = F.when(F.col("_record").isNull(), F.array(F.lit("JSON parse error"))).otherwise(
        variant_errors(RULES["chunk"], "_record")
    )
    return once(record, {"errors": errors}).select(
        *lines.columns,
        F.col("_record").isNotNull().alias("parsed"),
        "errors",
        (F.size("errors") == 0).alias("valid"),
        F.coalesce(F.try_variant_get("_record", "$.project", "string"), F.lit("unknown")).alias("project"),
    )


def audit_by_file(audited: DataFrame) -> DataFrame:
    """Total, valid and invalid chunks per file; a line that is no JSON is invalid but no chunk."""
    return audited.groupBy("file").agg(
        F.count_if("parsed").alias("total"),
        F.count_if("valid").alias("valid"),
        F.count_if(~F.col("valid")).alias("invalid"),
    )


def audit_by_project(audited: DataFrame) -> DataFrame:
    """Valid chunks per project and the number of distinct file names they are in."""
    name = F.regexp_extract("file", r"([^/]*)$", 1)
    return (
        audited.where("valid")
        .groupBy("project", name.alias("_name"))
        .agg(F.count("*").alias("_n"))
        .groupBy("project")
        .agg(F.sum("_n").alias("chunks"), F.count("*").alias("files"))
    )


def audit_totals(by_file: DataFrame) -> DataFrame:
    """Totals of the audit and whether generation may start."""
    totals = by_file.agg(
        F.count("*").alias("total_files"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("total_chunks"),
        F.coalesce(F.sum("valid"), F.lit(0)).alias("valid_chunks"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_chunks"),
    )
    return totals.withColumn("ready", (F.col("total_chunks") > 0) & (F.col("invalid_chunks") == 0))


def first_errors(audited: DataFrame, n: int = 10) -> DataFrame:
    """The first few bad lines in file and line order."""
    return (
        audited.where(~F.col("valid"))
        .select("file", "line", F.array_join("errors", "; ").alias("error"))
        .orderBy("file", "line")
        .limit(n)
    )


def sample_chunk(chunks: DataFrame) -> DataFrame:
    """The first chunk of the first file."""
    return chunks.orderBy("project", "file_path", "chunk_index").limit(1)
