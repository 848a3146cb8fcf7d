"""Stage three: verified items to shards, manifest and dataset info."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.operators import packing
from chunkwright.session import configure, durable
from chunkwright.sources.jsonl import checked_items, read_lines
from chunkwright.sources.shards import write_named_lines


def pack_dataset(
    spark: SparkSession,
    verified: str | DataFrame,
    output: str,
    run_id: str,
    created_at: str,
    seed: int | None = None,
    ratios: Mapping[str, float] | None = None,
    shard_size: int = packing.SHARD_SIZE,
    with_manifest: bool = True,
) -> DataFrame:
    """Write ``output/shards/*.jsonl`` and the two summary files; return the split table.

    Files are moved into place when all are written, and shards of an earlier dataset go; a job
    that fails before leaves the earlier dataset as it was.

    ``verified`` is a folder of JSON lines, or lines ``(file, value)`` such as the current ones
    of a workspace.  Lines that break the item rules are left out of the dataset, as its rules
    ask; count them with ``checked_items``.  Without any valid item nothing is written.
    """
    configure(spark)
    seed = packing.resolve_seed(seed)
    ratios = packing.DEFAULT_RATIOS if ratios is None else ratios
    lines = read_lines(spark, verified) if isinstance(verified, str) else verified
    items = durable(checked_items(lines).where("valid").select("id", "value"), "items")
    placed = packing.assign_splits(packing.shuffle_rank(items, seed), ratios)
    sharded = packing.assign_shards(placed, shard_size)
    table = packing.split_table(packing.split_sizes(items, ratios), shard_size)
    if items.isEmpty():
        return table
    lines = sharded.select(F.concat(F.lit("shards/"), "file").alias("file"), "rank_in_split", "value")
    info = packing.dataset_info(table, run_id, seed, created_at)
    summaries = {"dataset_info.json": info}
    if with_manifest:
        summaries["manifest.json"] = packing.manifest(table, run_id, seed, created_at)
    for name, row in summaries.items():
        text = row.select(F.lit(name).alias("file"), F.lit(0).alias("rank_in_split"), F.to_json(F.struct("*")).alias("value"))
        lines = lines.unionByName(text)
    write_named_lines(lines, output, order="rank_in_split", replace=["shards"])
    return table
