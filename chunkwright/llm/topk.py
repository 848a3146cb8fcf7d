"""Exact top-k search by inner product: a ball tree per shard, searched by branch and bound.

Vectors are spread over shards, whose points are written once; a task makes a ball tree of them.  Queries are searched
in blocks of at most ``QUERY_BLOCK`` vectors, which bounds what is broadcast.  In a tree, nodes
come in the order of their upper bound ``q . centre + |q| * radius``; a node is left out when its
bound is below the query's current k-th score.  The shards of a first wave find a k-th score for
each query, and the other shards start from it.

Components become ``floor(64 * x)``; scores are integers, exact as long as they fit 53 bits, which
is checked.  Vectors that are null, empty, or hold null or non-finite components take no part,
nor do rows with a null id; vectors are compared with queries of equal length only, so each
length has trees of its own.  Rows that share a ``vec_id`` are searched each; a query is its id
with one vector (the smallest), and all rows of its id are left out.  Ties go to the smaller id.
Equal vectors fill leaves like any others.  An empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwright.session import durable

SCALE = 64
LEAF = 256
SHARD_ROWS = 8_192
QUERY_BLOCK = 8_192
# One shard in so many belongs to the first wave.
FIRST_WAVE = 8
EXACT = float(1 << 53)


def integer_vectors(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, v, dim`` of the rows that take part."""
    x = F.transform(F.col(embedding), lambda c: c.cast("double"))
    sound = F.coalesce(
        F.col(vec_id).isNotNull() & (F.size(x) > 0)
        & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))),
        F.lit(False),
    )
    rows = embeddings.where(sound).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.transform(x, lambda c: F.floor(c * SCALE).cast("bigint")).alias("v")
    )
    return rows.withColumn("dim", F.size("v"))


class BallTree:
    """Points in leaf order with, per node, centre, radius and the range of its points."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.order: list[np.ndarray] = []
        self.nodes: list[tuple[np.ndarray, float, int, int]] = []  # centre, radius, left child or -1, leaf
        self.children: list[tuple[int, int] | None] = []
        self.points, self.ids = points, ids
        self._split(np.arange(len(ids)))

    def _split(self, rows: np.ndarray) -> int:
        points = self.points[rows]
        centre = points.mean(0)
        away = np.sqrt(((points - centre) ** 2).sum(1))
        node = len(self.nodes)
        self.nodes.append((centre, float(away.max(initial=0.0)), node, len(self.order)))
        self.children.append(None)
        if len(rows) <= LEAF:
            self.order.append(rows)
            return node
        # The two poles: the point farthest from the centre, and the one farthest from that.
        a = points[away.argmax()]
        b = points[((points - a) ** 2).sum(1).argmax()]
        along = points @ (b - a)
        half = len(rows) // 2
        cut = np.argpartition(along, half)
        left, right = rows[cut[:half]], rows[cut[half:]]
        self.children[node] = (self._split(left), self._split(right))
        return node


def search(tree: BallTree, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
    """``(query row, vec_id, score)`` arrays of every query's best ``k``, none below its floor.

    ``floors`` are k-th scores known from elsewhere (-inf: none) and rise as the search goes on.
    """
    norms = np.sqrt((queries**2).sum(1))
    floors = floors.copy()
    best_scores = np.full((len(queries), k), -np.inf)
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)

    def bounds(node: int, rows: np.ndarray) -> np.ndarray:
        centre, radius, _, _ = tree.nodes[node]
        bound = queries[rows] @ centre + norms[rows] * radius
        return bound + 1e-9 * (np.abs(bound) + 1) + 1e-6  # rounding must never lower a bound

    everyone = np.arange(len(queries))
    first = bounds(0, everyone)
    agenda = [(-float(first.max(initial=-np.inf)), 0, everyone, first)]
    while agenda:
        _, node, rows, bound = heapq.heappop(agenda)
        rows = rows[bound >= floors[rows]]
        if not len(rows):
            continue
        if tree.children[node] is not None:
            for child in tree.children[node]:
                bound = bounds(child, rows)
                near = bound >= floors[rows]
                if near.any():
                    heapq.heappush(agenda, (-float(bound[near].max()), child, rows[near], bound[near]))
            continue
        members = tree.order[tree.nodes[node][3]]
        ids = tree.ids[members]
        scores = queries[rows] @ tree.points[members].T
        scores[query_ids[rows][:, None] == ids[None, :]] = -np.inf
        scores[scores < floors[rows][:, None]] = -np.inf
        hit = np.flatnonzero((scores > -np.inf).any(1))
        if not len(hit):
            continue
        rows, scores = rows[hit], scores[hit]
        all_scores = np.concatenate([best_scores[rows], scores], 1)
        all_ids = np.concatenate([best_ids[rows], np.broadcast_to(ids, scores.shape)], 1)
        by_id = np.argsort(all_ids, axis=1, kind="stable")
        by_score = np.argsort(-np.take_along_axis(all_scores, by_id, 1), axis=1, kind="stable")[:, :k]
        top = np.take_along_axis(by_id, by_score, 1)
        best_scores[rows] = np.take_along_axis(all_scores, top, 1)
        best_ids[rows] = np.take_along_axis(all_ids, top, 1)
        floors[rows] = np.maximum(floors[rows], best_scores[rows, -1])
    found = best_scores > -np.inf
    row, slot = np.nonzero(found)
    return row, best_ids[row, slot], best_scores[row, slot]


TREE = "shard bigint, dim int, ids binary, points binary"
HITS = "query_id bigint, vec_id bigint, score bigint"


def build_shards(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One written row per shard and vector length: its ids and points, end to end."""
    total = vectors.count()
    shards = max(1, -(-total // shard_rows))
    # The place of a row follows from its id and number only, so equal vectors spread like others.
    spread = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)))

    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(rows["v"].to_numpy()).astype("<i8")
        ids = rows["vec_id"].to_numpy("<i8")
        order = np.argsort(ids, kind="stable")
        return pd.DataFrame({"shard": [key[0]], "dim": [key[1]], "ids": [ids[order].tobytes()], "points": [points[order].tobytes()]})

    return durable(spread.groupBy("shard", "dim").applyInPandas(pack, TREE), "vector-shards")


def _wave(shards: DataFrame, queries: dict[int, tuple], k: int) -> DataFrame:
    """Search the given shards; ``queries`` has, per vector length, ids, vectors and floors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["dim"] not in queries:
                    continue
                query_ids, vectors, floors = queries[row["dim"]]
                ids = np.frombuffer(row["ids"], "<i8")
                points = np.frombuffer(row["points"], "<i8").reshape(len(ids), -1).astype(np.float64)
                wide = vectors.astype(np.float64)
                top = max(np.abs(points).max(), 1) * max(np.abs(wide).max(initial=0), 1) * points.shape[1]
                if top >= EXACT:
                    raise ValueError("scores of these vectors do not fit 53 bits")
                at, found, score = search(BallTree(ids, points), query_ids, wide, floors, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[at], pa.int64()), pa.array(found, pa.int64()), pa.array(score.astype(np.int64), pa.int64())],
                    ["query_id", "vec_id", "score"],
                )

    return shards.mapInArrow(run, HITS)


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query; a query has at most ``k`` hits per shard."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(embeddings: DataFrame, is_query: Column, k: int = 20, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of every row that ``is_query`` holds for."""
    vectors = durable(integer_vectors(embeddings), "vectors")
    shards = build_shards(vectors)
    chosen = vectors.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-chosen.count() // query_block))
    # Hashed into blocks with room to spare; a block is a bounded number of rows.
    numbered = durable(chosen.withColumn("block", F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(blocks))), "query-blocks")
    hits = None
    for block in range(blocks):
        rows = numbered.where(F.col("block") == block).orderBy("vec_id").toPandas()
        by_length: dict[int, list] = {}
        for i, v in zip(rows["vec_id"], rows["v"]):
            by_length.setdefault(len(v), []).append((i, v))
        queries = {
            n: (np.array([i for i, _ in r], np.int64), np.array([v for _, v in r], np.int64), np.full(len(r), -np.inf))
            for n, r in by_length.items()
        }
        # A single partition per shard row: a shard is the unit of work.
        first = durable(_wave(shards.where(F.col("shard") % FIRST_WAVE == 0), queries, k), "first-wave")
        kth = {r.query_id: r.score for r in _best(first, k).where(F.col("rank") == k).select("query_id", "score").collect()}
        for ids, _, floors in queries.values():
            floors[:] = [kth.get(i, -np.inf) for i in ids.tolist()]
        rest = durable(_wave(shards.where(F.col("shard") % FIRST_WAVE != 0), queries, k), "other-waves")
        both = first.unionByName(rest)
        hits = both if hits is None else hits.unionByName(both)
    return _best(hits, k)


ORACLE = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
