"""Bounded, documented samples of labelled documents, and the fold rule of the label queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.shared import keyed_texts


def fold(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, use: Column, limit: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``limit`` labelled documents.

    Labels other than 0 and 1 and null keys do not count; of contradicting labels the larger one
    holds.  The labels taken are those with the smallest key hashes, so a run repeats them.  They
    are ``limit`` rows at most, which bounds what is broadcast; of several documents with one key the one
    whose text has the smallest hash counts, so no more documents than labels come back.
    """
    clean = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")
    )
    usable = clean.where(use).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    found = keyed_texts(documents).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("label").alias("label"))
