import hashlib
import math

import pytest
from pyspark.sql import functions as F

from chunkwright.operators import packing
from chunkwright.operators.ranking import running_totals
from chunkwright.operators.requests import request_plan, token_estimate
from chunkwright.operators.prompts import messages


def ids(spark, n, parts=5):
    return spark.range(n).select(F.format_string("id-%06d", "id").alias("id")).repartition(parts)


def brute_order(n, seed):
    names = [f"id-{i:06d}" for i in range(n)]
    return sorted(names, key=lambda x: (hashlib.sha256(f"{seed}|{x}".encode()).hexdigest(), x))


@pytest.mark.parametrize("n, seed", [(0, 1), (1, 1), (1000, 42), (1000, 43)])
def test_rank_is_a_seeded_permutation(spark, n, seed):
    rows = packing.shuffle_rank(ids(spark, n), seed).collect()
    assert {r.id: r["rank"] for r in rows} == {x: i for i, x in enumerate(brute_order(n, seed))}
    assert all(r.total == n for r in rows)


def test_rank_does_not_depend_on_partitions(spark):
    a, b = (sorted(map(tuple, packing.shuffle_rank(ids(spark, 500, p), 9).collect())) for p in (1, 13))
    assert a == b


def test_running_totals_by_lane(spark):
    df = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("lane"), F.sha2(F.col("id").cast("string"), 256).alias("d"), "id"
    )
    rows = running_totals(df, "d", {"n": F.lit(1), "s": F.col("id")}, lanes=["lane"]).collect()
    for lane in "ab":
        n = s = 0
        for r in sorted((r for r in rows if r.lane == lane), key=lambda r: r.d):
            n, s = n + 1, s + r.id
            assert (r.n, r.s) == (n, s)
        assert {(r.n_total, r.s_total) for r in rows if r.lane == lane} == {(n, s)}


@pytest.mark.parametrize(
    "n, ratios, size",
    [
        (1000, {"train": 0.98, "test": 0.02}, 50),
        (997, {"train": 0.8, "val": 0.1, "test": 0.1}, 7),
        (10, {"a": 2, "b": 1, "c": 1}, 3),
        (3, {"a": 0.9, "b": 0.05, "c": 0.05}, 5000),
        (20, {"none": 0.0, "all": 1.0}, 20),
    ],
)
def test_splits_and_shards(spark, n, ratios, size):
    total = sum(ratios.values())
    scaled = ratios if 0.99 <= total <= 1.01 else {k: v / total for k, v in ratios.items()}
    want, rest = {}, brute_order(n, 42)
    for name in ratios:
        take = len(rest) if name == list(ratios)[-1] else int(n * scaled[name])
        want[name], rest = rest[:take], rest[take:]
    placed = packing.assign_splits(packing.shuffle_rank(ids(spark, n), 42), ratios)
    rows = packing.assign_shards(placed, size).collect()
    got = {name: [] for name in ratios}
    for r in sorted(rows, key=lambda r: r.rank_in_split):
        got[r.split].append(r.id)
        assert r.shard == r.rank_in_split // size and r.file == f"{r.split}-{r.shard:05d}.jsonl"
    assert got == want
    table = packing.split_table(packing.split_counts(placed, ratios), size)
    for r in table.collect():
        k = len(want[r.split])
        assert (r.num_items, r.num_shards) == (k, math.ceil(k / size))
        assert [tuple(s) for s in r.shards] == [
            (f"{r.split}-{i:05d}.jsonl", min(size, k - i * size)) for i in range(r.num_shards)
        ]
    sizes = packing.split_sizes(ids(spark, n), ratios)
    assert sizes.orderBy("position").collect() == packing.split_counts(placed, ratios).orderBy("position").collect()
    counted = {r.file: r.num_items for r in packing.shard_counts(packing.assign_shards(placed, size)).collect()}
    assert counted == {s.file: s.num_items for r in table.collect() for s in r.shards}
    made = packing.manifest(table, "run_20240101_000000", 42, "now")
    document = made.select("total_items", F.map_keys("splits").alias("names")).first()
    assert document.total_items == n and document.names == list(ratios)
    info = packing.dataset_info(table, "run_20240101_000000", 42, "now").first()
    assert {k: v.num_shards for k, v in info.splits.items()} == {k: math.ceil(len(v) / size) for k, v in want.items()}


def test_ratios_a_little_over_one(spark):
    ratios = {"a": 0.5, "b": 0.51, "c": 0.0}
    placed = packing.assign_splits(packing.shuffle_rank(ids(spark, 1000), 1), ratios)
    want = packing.split_counts(placed, ratios).orderBy("position").collect()
    assert packing.split_sizes(ids(spark, 1000), ratios).orderBy("position").collect() == want
    assert [r.num_items for r in want] == [500, 500, 0]


def test_bad_settings():
    for ratios in ({}, {"a": 0.0}, {"a": -1.0, "b": 2.0}):
        with pytest.raises(ValueError):
            packing.normalize_ratios(ratios)
    assert packing.resolve_seed(5) == 5 and packing.resolve_seed(None) > 1_600_000_000


def test_token_estimate(spark):
    texts = ["", "one", "a b  c\n d", "x " * 33]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(token_estimate(messages("sys two", F.col("t")), 100)).collect()]
    assert got == [int(sum(len(p.split()) * 1.3 for p in ("sys two", t)) + 100) for t in texts]


def test_request_plan_matches_a_serial_budget(spark):
    df = spark.range(300).select(
        F.col("id").cast("string").alias("request_id"),
        messages("s", F.repeat(F.lit("w "), (F.col("id") % 40).cast("int"))).alias("messages"),
    )
    rows = request_plan(df, max_tokens=10, requests_per_minute=7, tokens_per_minute=60).collect()
    requests = tokens = 0
    for r in sorted(rows, key=lambda r: hashlib.sha256(r.request_id.encode()).hexdigest()):
        words = int(r.request_id) % 40
        assert r.estimate == int((1 * 1.3 + words * 1.3) + 10)
        assert r.rejected == (r.estimate > 60)
        if r.rejected:
            assert r.minute is None
            continue
        requests, tokens = requests + 1, tokens + r.estimate
        assert r.minute == max((requests - 1) // 7, (tokens - 1) // 60)
    assert any(r.rejected for r in rows)
    with pytest.raises(ValueError):
        request_plan(df, requests_per_minute=0)
