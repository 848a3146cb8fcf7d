"""Exact running totals over a whole table without a single-task window.

Rows are ordered by a hex digest.  Its leading digits put the rows into buckets that
are already in order and, digests being uniform, alike in size.  Each bucket is summed
first; what lies before a bucket is a running sum over that small table, and only the
rows of one bucket meet in a window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Four hex digits: at most 65,536 bucket rows per lane, whatever the size of the table.
DIGITS = 4


def running_totals(
    df: DataFrame,
    digest: str,
    measures: Mapping[str, Column],
    tie: Sequence[str] = (),
    lanes: Sequence[str] = (),
) -> DataFrame:
    """Add, per measure ``m``, the inclusive running sum ``m`` and the total ``m_total``.

    ``digest`` names a hex digest column that orders the rows within a lane; ``tie``
    breaks equal digests.  Digest and tie together must be unique.
    """
    lanes = list(lanes)
    valued = df.withColumn("_bucket", F.substring(digest, 1, DIGITS)).withColumns(
        {f"_v_{name}": value.cast("bigint") for name, value in measures.items()}
    )
    sums = valued.groupBy(*lanes, "_bucket").agg(*[F.sum(f"_v_{m}").alias(f"_s_{m}") for m in measures])
    across = Window.partitionBy(*lanes) if lanes else Window.partitionBy(F.lit(0))
    before = across.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sums.select(
        *lanes,
        "_bucket",
        *[(F.sum(f"_s_{m}").over(before) - F.col(f"_s_{m}")).alias(f"_b_{m}") for m in measures],
        *[F.sum(f"_s_{m}").over(across).alias(f"{m}_total") for m in measures],
    )
    inside = (
        Window.partitionBy(*lanes, "_bucket")
        .orderBy(digest, *tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = valued.select(
        *df.columns, "_bucket", *[F.sum(f"_v_{m}").over(inside).alias(f"_l_{m}") for m in measures]
    )
    # Without lanes the offsets are at most 65,536 rows, a bound that lets them be broadcast.  With
    # lanes there is no such bound; the rows already lie by lane and bucket, as the join needs them.
    placed = local.join(offsets if lanes else F.broadcast(offsets), [*lanes, "_bucket"])
    return placed.select(
        *[local[c] for c in df.columns],
        *[(F.col(f"_b_{m}") + F.col(f"_l_{m}")).alias(m) for m in measures],
        *[F.col(f"{m}_total") for m in measures],
    )
