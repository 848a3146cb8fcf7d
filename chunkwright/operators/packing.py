"""Seeded shuffle, ratio splits, fixed-size shards, manifest and dataset info."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.functions.text import empty_array
from chunkwright.operators.ranking import running_totals

# The default split and shard size, and the shard file name.
DEFAULT_RATIOS = {"train": 0.98, "test": 0.02}
SHARD_SIZE = 5000
SHARD_FILE = "%s-%05d.jsonl"


def resolve_seed(seed: int | None) -> int:
    """The seed given, or one from the clock."""
    return int(time.time()) if seed is None else seed


def shuffle_rank(items: DataFrame, seed: int, key: str = "id") -> DataFrame:
    """Add ``rank``, a seeded permutation 0..n-1, and ``total``.

    The order is that of a hash of seed and id, so it does not depend on how the items
    are partitioned.  ``key`` must be unique, as item ids are.
    """
    keyed = items.withColumn("_digest", F.sha2(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")), 256))
    ranked = running_totals(keyed, "_digest", {"_n": F.lit(1)}, tie=[key])
    return ranked.select(
        *items.columns, (F.col("_n") - 1).alias("rank"), F.col("_n_total").alias("total")
    )


def normalize_ratios(ratios: Mapping[str, float]) -> dict[str, float]:
    """Ratios that sum to about one stay as they are; others are scaled to it."""
    if not ratios or any(r < 0 for r in ratios.values()) or sum(ratios.values()) <= 0:
        raise ValueError("ratios must name at least one split and must not be negative")
    total = sum(ratios.values())
    if 0.99 <= total <= 1.01:
        return dict(ratios)
    return {name: r / total for name, r in ratios.items()}


def _boundaries(ratios: Mapping[str, float], total: Column) -> list[tuple[str, Column, Column]]:
    """``(split, first rank, end rank)`` in declared order; the last split takes the rest."""
    names = list(ratios)
    out, start = [], F.lit(0).cast("bigint")
    for name in names:
        end = total if name == names[-1] else start + (total * F.lit(float(ratios[name]))).cast("bigint")
        out.append((name, start, end))
        start = end
    return out


def assign_splits(ranked: DataFrame, ratios: Mapping[str, float] | None = None) -> DataFrame:
    """Add ``split`` and ``rank_in_split``."""
    split, offset = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    bounds = _boundaries(normalize_ratios(DEFAULT_RATIOS if ratios is None else ratios), F.col("total"))
    for name, start, end in reversed(bounds):
        inside = (F.col("rank") >= start) & (F.col("rank") < end)
        split = F.when(inside, F.lit(name)).otherwise(split)
        offset = F.when(inside, F.col("rank") - start).otherwise(offset)
    return ranked.withColumns({"split": split, "rank_in_split": offset})


def assign_shards(placed: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Add ``shard`` and its ``file`` name."""
    if shard_size <= 0:
        raise ValueError("shard_size must be positive")
    shard = F.floor(F.col("rank_in_split") / shard_size).cast("int")
    return placed.withColumn("shard", shard).withColumn("file", F.format_string(SHARD_FILE, "split", "shard"))


def split_counts(placed: DataFrame, ratios: Mapping[str, float] | None = None) -> DataFrame:
    """Items per declared split, empty splits included."""
    spark = placed.sparkSession
    names = list(DEFAULT_RATIOS if ratios is None else ratios)
    declared = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "position int, split string")
    counts = placed.groupBy("split").agg(F.count("*").alias("num_items"))
    return declared.join(counts, "split", "left").select(
        "position", "split", F.coalesce("num_items", F.lit(0)).cast("bigint").alias("num_items")
    )


def split_sizes(items: DataFrame, ratios: Mapping[str, float] | None = None) -> DataFrame:
    """As ``split_counts``, from one count of the items: their places are not needed for it."""
    total = F.col("total")
    bounds = _boundaries(normalize_ratios(DEFAULT_RATIOS if ratios is None else ratios), total)
    # Ratios that sum to a little over one reach past the last item.
    sizes = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("split"),
            F.greatest(F.least(end, total) - F.least(start, total), F.lit(0).cast("bigint")).alias("num_items"),
        )
        for i, (name, start, end) in enumerate(bounds)
    ]
    return items.agg(F.count("*").alias("total")).select(F.inline(F.array(*sizes)))


def shard_counts(sharded: DataFrame) -> DataFrame:
    """Items per shard file."""
    return sharded.groupBy("split", "shard", "file").agg(F.count("*").alias("num_items"))


def split_table(counts: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Per split its items, number of shards and shard list.

    Every shard but the last is full, so the list follows from the count alone and no
    shard rows are gathered in one task.
    """
    num_shards = F.ceil(F.col("num_items") / shard_size).cast("bigint")
    shards = F.transform(
        F.when(num_shards > 0, F.sequence(F.lit(0).cast("bigint"), num_shards - 1)).otherwise(
            empty_array("bigint")
        ),
        lambda i: F.struct(
            F.format_string(SHARD_FILE, F.col("split"), i).alias("file"),
            F.least(F.lit(shard_size).cast("bigint"), F.col("num_items") - i * shard_size).alias("num_items"),
        ),
    )
    return counts.select("position", "split", "num_items", num_shards.alias("num_shards"), shards.alias("shards"))


def _document(table: DataFrame, run_id: str, seed: int, created_at: str, value: Column) -> DataFrame:
    # One row per declared split: gathering them is bounded by the ratios given.
    by_split = F.map_from_entries(
        F.transform(
            F.array_sort(F.collect_list(F.struct("position", F.col("split"), value.alias("value")))),
            lambda e: F.struct(e["split"], e["value"]),
        )
    )
    return table.agg(by_split.alias("splits"), F.sum("num_items").alias("total_items")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(created_at).alias("created_at"),
        "total_items",
        F.lit(seed).cast("bigint").alias("shuffle_seed"),
        "splits",
    )


def manifest(table: DataFrame, run_id: str, seed: int, created_at: str) -> DataFrame:
    """The manifest as one typed row."""
    return _document(table, run_id, seed, created_at, F.struct("num_items", "shards"))


def dataset_info(table: DataFrame, run_id: str, seed: int, created_at: str) -> DataFrame:
    """The summary as one typed row."""
    return _document(table, run_id, seed, created_at, F.struct("num_items", "num_shards"))
