"""Sharding along a Hilbert curve over several metadata dimensions.

Language, source and size are quantised to five bits each, and rows are sorted by the index of
their cell on the three-dimensional Hilbert curve; runs of that order are the shards, so a shard
covers a compact region and files can be skipped by any of the dimensions.  Shard sizes follow
the law ``rows``: counts differ by one at most.

Rows with equal texts take the smallest language and source among them, so they share a cell and
lie side by side; only a cut between shards can part them.  Order within a cell: text hash, then a
hash of ``doc_id``, ``doc_id`` and the row's own metadata.  Null texts have no bytes (size 16) and count
as empty; null metadata quantises like the empty text.  Equal rows get a slot each.  Other columns
are ignored.  An empty table has no shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkwright.session import durable

BITS = 5
SIDE = 1 << BITS
SHARDS = 40
ROW_OVERHEAD = 16
# Rows per range of the global sort; many ranges, each small enough for a task.
RANGE_ROWS = 1 << 20


def category_cell(value: Column) -> Column:
    return (F.crc32(F.coalesce(value.cast("string"), F.lit(""))) % SIDE).cast("int")


def size_cell(size: Column) -> Column:
    """Half powers of two from 16 bytes to a megabyte, by the leading two bits."""
    digits = F.length(F.bin(size))
    second = F.substring(F.bin(size), 2, 1).cast("int")
    return F.least(F.greatest(2 * (digits - 5) + second, F.lit(0)), F.lit(SIDE - 1)).cast("int")


def curve_table(spark: SparkSession) -> DataFrame:
    """Cell ``(x0, x1, x2)`` to curve index, for all 32,768 cells.

    The axes are turned level by level from the highest bit down and then Gray-decoded; the
    bits of the result, interleaved, are the index.
    """
    cells = spark.range(SIDE**3).select(
        F.col("id").cast("int").alias("cell"),
        (F.shiftright("id", 2 * BITS)).cast("int").alias("x0"),
        (F.shiftright("id", BITS) % SIDE).cast("int").alias("x1"),
        (F.col("id") % SIDE).cast("int").alias("x2"),
    )
    # One step per level and axis, flattened: 3 * level + axis.
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(a).alias("axis")) for b in range(BITS - 1, 0, -1) for a in range(3)])

    def turn(x: Column, step: Column) -> Column:
        q, axis = step["q"], step["axis"]
        own = F.when(axis == 0, x["x0"]).when(axis == 1, x["x1"]).otherwise(x["x2"])
        inverted = own.bitwiseAND(q) != 0
        swap = x["x0"].bitwiseXOR(own).bitwiseAND(q - 1)
        change = F.when(inverted, 0).otherwise(swap)
        return F.struct(
            F.when(inverted, x["x0"].bitwiseXOR(q - 1)).otherwise(x["x0"].bitwiseXOR(swap)).alias("x0"),
            F.when(axis == 1, x["x1"].bitwiseXOR(change)).otherwise(x["x1"]).alias("x1"),
            F.when(axis == 2, x["x2"].bitwiseXOR(change)).otherwise(x["x2"]).alias("x2"),
        )

    def gray(x: Column) -> Column:
        second = x["x1"].bitwiseXOR(x["x0"])
        third = x["x2"].bitwiseXOR(second)
        fold = F.aggregate(
            F.array(*[F.lit(1 << b) for b in range(BITS - 1, 0, -1)]),
            F.lit(0),
            lambda t, q: F.when(third.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t),
        )
        return F.struct(x["x0"].bitwiseXOR(fold).alias("x0"), second.bitwiseXOR(fold).alias("x1"), third.bitwiseXOR(fold).alias("x2"))

    turned = cells.select("cell", F.aggregate(steps, F.struct("x0", "x1", "x2"), turn, gray).alias("x"))
    index = sum(
        F.shiftleft(F.shiftright(F.col("x")[f"x{a}"], b).bitwiseAND(F.lit(1)), 3 * b + 2 - a)
        for b in range(BITS)
        for a in range(3)
    )
    return turned.select("cell", index.cast("int").alias("curve"))


def shard_plan(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, curve, shard, slot`` of every row."""
    spark = documents.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = durable(
        documents.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text) + ROW_OVERHEAD).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        ),
        "shard-rows",
    )
    same = ["text_hash", "text_crc32", "size"]
    groups = rows.groupBy(*same).agg(F.min("lang").alias("group_lang"), F.min("source").alias("group_source"))
    cell = (category_cell(F.col("group_lang")) * SIDE + category_cell(F.col("group_source"))) * SIDE + size_cell(F.col("size"))
    # The curve is a table of 32,768 rows, a fixed bound, so it is broadcast.
    curve = groups.withColumn("cell", cell).join(F.broadcast(curve_table(spark)), "cell").drop("cell")
    keyed = rows.join(curve, same).withColumn("salt", F.xxhash64(F.lit(7), "doc_id"))
    order = ["curve", "text_hash", "size", "text_crc32", "salt", "doc_id", "lang", "source"]
    total = rows.count()
    ranges = max(1, -(-total // RANGE_ROWS), spark.sparkContext.defaultParallelism)
    # The written ranges fix each row's place; equal rows that swap places are alike.
    placed = durable(
        keyed.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "size", "text_crc32", "curve", F.monotonically_increasing_id().alias("place")),
        "shard-places",
    )
    part = F.shiftright("place", 33).alias("part")
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    # One row per range of a million rows: a bounded table, summed up in one small window.
    starts = counts.select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")
    )
    rank = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    # The first `extra` shards hold one row more than the others.
    few, extra = divmod(total, shards)
    edge = extra * (few + 1)
    head = F.expr(f"rank div {few + 1}")
    tail = F.expr(f"{extra} + (rank - {edge}) div {max(few, 1)}")
    ranked = placed.withColumn("part", part).join(starts, "part").withColumn("rank", rank)
    return ranked.withColumn("shard", F.when(F.col("rank") < edge, head).otherwise(tail).cast("int")).select(
        "doc_id", "size", "text_crc32", "curve", "shard",
        (F.col("rank") - F.when(F.col("shard") < extra, F.col("shard") * (few + 1)).otherwise(edge + (F.col("shard") - extra) * few))
        .cast("bigint").alias("slot"),
    )


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS, files_per_shard: int = 1) -> None:
    """Write the documents as parquet below ``path/shard=N``, in slot order within each file.

    Every row is written once: rows are numbered when they are first stored, and the number ties a row to
    its place, so ids may be null or repeated.
    """
    stored = durable(documents.withColumn("_hb_row", F.monotonically_increasing_id()), "numbered-rows")
    plan = shard_plan(stored.withColumn("doc_id", F.col("_hb_row")), shards).select(F.col("doc_id").alias("_hb_row"), "shard", "slot")
    per = F.expr(f"slot % {files_per_shard}")
    clash = [c for c in documents.columns if c in ("shard", "slot")]
    placed = stored.drop(*clash).join(plan, "_hb_row").repartition(shards * files_per_shard, "shard", per)
    placed.sortWithinPartitions("shard", "slot").drop("_hb_row", "slot").write.partitionBy("shard").parquet(path)


def shard_digests(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    plan = shard_plan(documents, shards)
    return plan.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )
