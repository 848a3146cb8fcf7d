"""Start times against a simulation of two buckets, request by request."""

import hashlib
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from chunkwright.operators import schedule
from chunkwright.operators.schedule import bucket_starts, request_schedule


def simulate(needs, rpm, tpm):
    """Starts in seconds of requests that need so many tokens, by filling and emptying both buckets."""
    level, now, starts = [Fraction(rpm), Fraction(tpm)], Fraction(0), []
    for tokens in needs:
        wants, rates = (1, tokens), (Fraction(rpm, 60), Fraction(tpm, 60))
        wait = max(Fraction(0), *((w - h) / r for w, h, r in zip(wants, level, rates)))
        now += wait
        level = [min(cap, h + wait * r) - w for cap, h, r, w in zip((rpm, tpm), level, rates, wants)]
        starts.append(now)
    return starts


@pytest.mark.parametrize("rows,digits_per_level,rpm,tpm", [(900, 2, 7, 500), (300, 2, 1000, 60), (500, 2, 3, 100_000), (40, 2, 5, 50), (0, 2, 5, 5)])
def test_starts_equal_a_simulation(spark, rows, digits_per_level, rpm, tpm):
    rng = random.Random(rows)
    data = [(f"r{i}", "ab"[i % 3 == 0], rng.randint(0, min(tpm, 90))) for i in range(rows)]
    df = spark.createDataFrame(data, "request_id string, lane string, tokens bigint").repartition(5)
    sized = df.withColumns({"digest": F.sha2("request_id", 256), "need": F.col("tokens") * rpm})
    got = {r.request_id: Fraction(r.start * 60, rpm * tpm) for r in bucket_starts(sized, "digest", "need", tpm, rpm * tpm, ["lane"]).collect()}
    want = {}
    for lane in "ab":
        ordered = sorted((hashlib.sha256(i.encode()).hexdigest(), i, n) for i, x, n in data if x == lane)
        want |= dict(zip((i for _, i, _ in ordered), simulate([n for *_, n in ordered], rpm, tpm)))
    assert got == want


def test_requests_with_burst_refill_and_rejection(spark):
    rows = [(f"{i}", [("user", "word " * (i % 9))]) for i in range(700)] + [("big", [("user", "word " * 4000)])]
    df = spark.createDataFrame(rows, "request_id string, messages array<struct<role: string, content: string>>")
    plan = {r.request_id: r for r in request_schedule(df, 100, 50, 3000).collect()}
    assert len(plan) == 701 and plan["big"].rejected and plan["big"].start_seconds is None and plan["big"].minute is None
    ordered = sorted((r for r in plan.values() if not r.rejected), key=lambda r: hashlib.sha256(r.request_id.encode()).hexdigest())
    want = simulate([r.estimate for r in ordered], 50, 3000)
    assert [Fraction(r.start_units * 60, 50 * 3000) for r in ordered] == want
    assert [r.minute for r in ordered] == [int(s // 60) for s in want]
    assert want[0] == 0 and sum(s == 0 for s in want) > 20 and want[-1] > 600
    with pytest.raises(ValueError):
        request_schedule(df, tokens_per_minute=0)


def test_groups_stay_small(spark, monkeypatch):
    df = spark.range(70_000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.lit(3).cast("bigint").alias("need"), "id")
    sizes = []
    written = schedule.durable
    monkeypatch.setattr(schedule, "durable", lambda d, name: (lambda w: (sizes.append(w.agg(F.max(F.size("_rows"))).first()[0]), w)[1])(written(d, name)))
    starts = [r.start for r in bucket_starts(df, "digest", "need", 1, 1000, []).orderBy("digest").collect()]
    assert starts == [max(0, 3 * (i + 1) - 1000) for i in range(70_000)]
    assert len(sizes) == 3 and max(sizes) < 400
