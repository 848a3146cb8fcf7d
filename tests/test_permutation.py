"""The keyed permutation of stored rows."""

import math

import pytest
from pyspark.sql import functions as F

from chunkwright.operators import packing
from chunkwright.operators.permutation import numbered_rows, permuted, permuted_rank


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 16, 17, 99, 1000, 4097, 30_011])
def test_a_bijection_for_every_total_and_seed(spark, n):
    for seed in (0, 42, 2**40):
        ranks = [r[0] for r in spark.range(n).select(permuted(F.col("id"), n, seed)).collect()]
        assert sorted(ranks) == list(range(n))
    if n > 100:
        other = [r[0] for r in spark.range(n).select(permuted(F.col("id"), n, 43)).collect()]
        assert sum(a == b for a, b in zip(ranks, other)) < 20


def test_large_totals_stay_in_range_and_apart(spark):
    n = 3_000_000_017
    df = spark.range(200_000).select((F.col("id") * 15_000).alias("id")).select(permuted(F.col("id"), n, 5).alias("rank"))
    told = df.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()
    assert 0 <= told[0] < n // 1000 and n - n // 1000 < told[1] < n and told[2] == 200_000


def test_ranks_look_random(spark):
    n, cells = 100_000, 50
    rows = spark.range(n).select((F.col("id") * cells / n).cast("int").alias("x"), (permuted(F.col("id"), n, 11) * cells / n).cast("int").alias("y"))
    counts = {(r.x, r.y): r["count"] for r in rows.groupBy("x", "y").count().collect()}
    expected = n / cells**2
    chi = sum((counts.get((x, y), 0) - expected) ** 2 / expected for x in range(cells) for y in range(cells))
    free = (cells - 1) ** 2
    assert abs(chi - free) < 6 * math.sqrt(2 * free)
    steps = spark.range(n - 1).select((permuted(F.col("id") + 1, n, 11) - permuted(F.col("id"), n, 11)).alias("d"))
    assert steps.groupBy("d").count().agg(F.max("count")).first()[0] < 20


def test_ranks_of_stored_rows_do_not_depend_on_the_scan(spark, tmp_path):
    spark.range(20_000).withColumn("row_number", F.lit("kept")).repartition(7).write.parquet(str(tmp_path / "t"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    try:
        for size in ("10000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            stored = spark.read.parquet(str(tmp_path / "t")).drop("row_number")
            found.append(sorted(map(tuple, permuted_rank(stored, 9).repartition(3).collect())))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found[0] == found[1]
    assert sorted(r[1] for r in found[0]) == list(range(20_000)) and {r[2] for r in found[0]} == {20_000}
    numbers = [r.row_number for r in numbered_rows(spark.read.parquet(str(tmp_path / "t")).drop("row_number")).collect()]
    assert sorted(numbers) == list(range(20_000))


def test_splits_and_shards_follow_the_ranks(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    ranked = permuted_rank(spark.read.parquet(str(tmp_path / "t")), 3)
    rows = packing.assign_shards(packing.assign_splits(ranked, {"a": 0.7, "b": 0.3}), 64).groupBy("split", "file").count().collect()
    assert {r.split: sum(x["count"] for x in rows if x.split == r.split) for r in rows} == {"a": 700, "b": 300}
    assert max(r["count"] for r in rows) == 64


def test_empty_tables(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "t"))
    assert permuted_rank(spark.read.schema("id bigint").parquet(str(tmp_path / "t")), 3).count() == 0
