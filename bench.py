"""Time the headline queries: one JSON line on standard output."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from chunkwright.session import get_spark  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "token_counts",
    "semantic_breaks",
    "chunks",
    "chunks_shipped_size",
    "chunk_stats",
    "gen_requests",
    "request_plan",
    "parse_robust",
    "local_checks",
    "verdict_merge",
    "run_totals",
    "chunk_audit_by_project",
    "shard_assign",
    "dataset_info",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_spark(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("OFF")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        # The first pass warms the JVM and the file cache.
        for _ in range(2):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - begin
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
