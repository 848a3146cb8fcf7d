"""Small helpers that several operators use."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start, start + 1, ...`` of every run, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


def text_parts(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, in order, whose texts have ``most`` bytes at most, or a single row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = before = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, end - start)
        start, before = end, int(ends[end - 1])


def keyed_texts(documents: DataFrame) -> DataFrame:
    """Only the key and the text (null: empty), whatever else the table carries."""
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def wide_hash(*columns: Column) -> Column:
    """A 128-bit hash as a struct of two seeded 64-bit hashes."""
    return F.struct(
        F.xxhash64(F.lit(1), *columns).alias("h1"), F.xxhash64(F.lit(2), *columns).alias("h2")
    )
