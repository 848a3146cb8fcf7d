"""Routing of verified and rejected items, and counts of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.operators.checks import ITEM_FIELDS


def verified_items(reported: DataFrame) -> DataFrame:
    """Item records that passed."""
    return reported.where("passed").select(*ITEM_FIELDS)


def rejected_items(reported: DataFrame) -> DataFrame:
    """``(item, verify_report)`` of the items that did not."""
    return reported.where(~F.col("passed")).select(F.struct(*ITEM_FIELDS).alias("item"), "verify_report")


def chunk_stats(chunks: DataFrame, reported: DataFrame) -> DataFrame:
    """Generated, verified and rejected items per chunk; zeros for chunks that gave none."""
    counts = reported.groupBy(F.col("metadata.chunk_id").alias("chunk_id")).agg(
        F.count("*").alias("generated_count"),
        F.count_if("passed").alias("verified_count"),
        F.count_if(~F.col("passed")).alias("rejected_count"),
    )
    names = ["generated_count", "verified_count", "rejected_count"]
    return (
        chunks.select("chunk_id")
        .join(counts, "chunk_id", "left")
        .select("chunk_id", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in names])
    )


def run_totals(stats: DataFrame) -> DataFrame:
    """One row of totals over the chunk stats."""
    return stats.agg(
        F.count("*").alias("total_chunks"),
        F.coalesce(F.sum("generated_count"), F.lit(0)).alias("total_generated"),
        F.coalesce(F.sum("verified_count"), F.lit(0)).alias("total_verified"),
        F.coalesce(F.sum("rejected_count"), F.lit(0)).alias("total_rejected"),
        F.count_if(F.col("generated_count") == 0).alias("failed_chunks"),
    ).withColumn("verification_rate", F.try_divide(F.col("total_verified") * F.lit(100.0), F.col("total_generated")))


def first_failed_chunks(stats: DataFrame, n: int = 5) -> DataFrame:
    """The first few chunk ids, in order, that gave no items."""
    return stats.where("generated_count = 0").select("chunk_id").orderBy("chunk_id").limit(n)


def failed_chunks(chunks: DataFrame, replies: DataFrame, parsed: DataFrame) -> DataFrame:
    """Chunks whose request or reply failed: where they stand, why, and their whole text."""
    asked = replies.where(F.col("status") != "ok").select(
        F.col("request_id").alias("chunk_id"), F.col("status").alias("error_type"), F.col("error").alias("error_message")
    )
    unread = parsed.where(F.col("failure").isNotNull() & (F.col("failure") != "empty reply")).select(
        "chunk_id", F.lit("unreadable").alias("error_type"), F.col("failure").alias("error_message")
    )
    return asked.unionByName(unread).join(
        chunks.select("chunk_id", "project", "file_path", "chunk_index", "text"), "chunk_id"
    )


def error_histogram(reported: DataFrame) -> DataFrame:
    """How many items carry each error."""
    return (
        reported.select(F.explode("verify_report.errors").alias("error"))
        .groupBy("error")
        .agg(F.count("*").alias("items"))
    )
