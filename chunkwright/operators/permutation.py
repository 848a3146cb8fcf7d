"""A seeded shuffle of a stored table that moves no rows.

Rows of Parquet files have numbers already: those of the files before theirs, in the order of their names, and their
place in the file.  A keyed bijection of ``0 .. n-1`` turns the number into the rank, row by row, so the only
exchange is one count per file, and neither splits of the scan nor a repartitioning changes a rank.

The bijection is a Feistel network on pairs ``(left, right)`` with ``left`` below ``a`` and ``right`` below ``b``, where
``a`` is about the root of ``n`` and ``a * b`` hardly more than ``n``.  A pair beyond ``n`` goes through the
network again until it falls below; since fewer than ``a`` pairs lie beyond, that is rare and always ends.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 8
# Times a number may go through the network; beyond is next to impossible, and an error.
WALKS = 64
_PRIME = 2_147_483_647


def _keys(seed: int) -> list[tuple[int, int]]:
    """Two numbers below the prime for every round."""
    digests = (hashlib.sha256(f"{seed}|{r}".encode()).digest() for r in range(ROUNDS))
    return [(int.from_bytes(d[:8]) % (_PRIME - 1) + 1, int.from_bytes(d[8:16]) % _PRIME) for d in digests]


def _sides(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _mixed(value: Column, key: Column) -> Column:
    """A cube modulo the prime, which spreads neighbouring values."""
    x = (value * key["times"] + key["plus"]) % _PRIME
    return ((x * x) % _PRIME * x + key["plus"]) % _PRIME


def _network(number: Column, n: int, seed: int) -> Column:
    """One pass: a bijection of the numbers below ``a * b``, of which ``n`` are wanted."""
    a, b = _sides(n)
    long = lambda value: F.lit(value).cast("bigint")
    # Every round renews one half by the other one, and the halves change places.
    rounds = F.array(*[
        F.struct(long(times).alias("times"), long(plus).alias("plus"), long((a, b)[r % 2]).alias("side")) for r, (times, plus) in enumerate(_keys(seed))
    ])
    begin = F.struct(((number - number % b) / b).cast("bigint").alias("x"), (number % b).alias("y"))
    step = lambda s, k: F.struct(s["y"].alias("x"), ((s["x"] + _mixed(s["y"], k)) % k["side"]).alias("y"))
    return F.aggregate(rounds, begin, step, lambda s: s["x"] * b + s["y"])


def permuted(number: Column, n: int, seed: int) -> Column:
    """The rank of a row number below ``n``: a bijection of ``0 .. n-1`` for every seed."""
    number = number.cast("bigint")
    again = lambda x, _: F.when(x < n, x).otherwise(_network(x, n, seed))
    ended = lambda x: F.when(x < n, x).otherwise(F.raise_error(F.lit("a number did not fall below the total")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), _network(number, n, seed), again, ended)


def numbered_rows(stored: DataFrame) -> DataFrame:
    """Add ``row_number`` from 0, in the order of file names and places in files, to a scan of Parquet files."""
    placed = stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    counts = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per file, however large the files are.
    before = Window.partitionBy(F.lit(0)).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, "_file").withColumn("row_number", F.col("_start") + F.col("_at")).drop("_file", "_at", "_start")


def permuted_rank(stored: DataFrame, seed: int) -> DataFrame:
    """Add ``rank``, a seeded permutation 0..n-1, and ``total`` to a scan of Parquet files."""
    total = stored.count()
    ranked = numbered_rows(stored).withColumn("rank", permuted(F.col("row_number"), total, seed)).drop("row_number")
    return ranked.withColumn("total", F.lit(total).cast("bigint"))
