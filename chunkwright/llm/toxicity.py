"""Toxic passages by maximum-scoring segment search over token log-odds.

Token scores are log-odds of toxic against other labelled documents under a Dirichlet prior
whose means are the token rates of the whole corpus.  A linear-time scan finds all maximal
scoring segments of a text; the chance that a clean text of its length holds a segment as good
follows an extreme-value law, whose constant is fitted on clean labelled documents.  The excess
of all significant segments over that law, summed, gives the score through a logistic curve.

A token is a lower-cased word without surrounding punctuation; it also counts under its first
five letters, so that unseen forms of a stem are known.  Tokens are hashed into ``BUCKETS``
buckets, which bounds the model.  Null and empty texts have no tokens and get the base score.
Repeated rows score alike.  ``labels`` may be empty: then every score is 0.
Ties cannot arise: a score depends on the text alone.  Very long texts are scanned whole, in linear time; an empty
``documents`` gives no rows, and other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.labelled import fold, labelled_sample
from chunkwright.llm.shared import keyed_texts
from chunkwright.session import durable

BUCKETS = 1 << 20
STEM = 5
# Labelled documents the model is fitted on, at most.
SAMPLE = 20_000
# Strength of the prior in tokens per class, and the likelihood ratio from which a token's log-odds count.
PRIOR = 1_000.0
SIGNIFICANT = 14.0
# Weaker log-odds are no sign of toxicity.
LEAST = 1.5
# What any other token costs a segment.
DRIFT = 0.3
THRESHOLD = 0.7
WORDS = 400_000  # distinct words a task remembers before it starts anew
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def buckets_of(word: str) -> tuple[int, int]:
    """Buckets of a raw word and of its stem; -1 for a word without letters."""
    word = _EDGE.sub("", word)
    if not word:
        return -1, -1
    stem = zlib.crc32(b"^" + word[:STEM].encode("utf-8", "replace")) % BUCKETS
    return zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS, stem


class _Numbers(dict):
    """Numbers words in order of first use."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def token_counts(texts: DataFrame, classes: Column) -> DataFrame:
    """``bucket, kind, n``: documents with each word, by bucket and class, summed over all rows."""
    rows = texts.select("text", classes.cast("int").alias("kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, counts = _Numbers(), {}

        def flush() -> Iterator[pa.RecordBatch]:
            pairs = np.array([buckets_of(w) for w in numbers] or np.zeros((0, 2)), np.int64)
            for kind, count in counts.items():
                count = count[: len(pairs)]
                known = pairs[: len(count)]
                at = np.concatenate([known[:, 0], known[:, 1]])
                n = np.concatenate([count, count])
                total = np.bincount(at[at >= 0], n[at >= 0], BUCKETS).astype(np.int64)
                hit = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hit, pa.int32()), pa.array(np.full(len(hit), kind), pa.int32()), pa.array(total[hit], pa.int64())],
                    ["bucket", "kind", "n"],
                )
            numbers.clear()
            counts.clear()

        for batch in batches:
            kinds = batch.column("kind").to_pylist()
            for text, kind in zip(batch.column("text").to_pylist(), kinds):
                words = text.lower().split()
                if not words:
                    continue
                # A word counts once per document, so that repetition inside one does not teach.
                found = np.bincount(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))) > 0
                old = counts.get(kind)
                if old is None or len(old) < len(found):
                    grown = np.zeros(2 * len(numbers) + 1024, np.int64)
                    if old is not None:
                        grown[: len(old)] = old
                    old = counts[kind] = grown
                old[: len(found)] += found
            if len(numbers) > WORDS:
                yield from flush()
        yield from flush()

    counted = rows.mapInArrow(run, "bucket int, kind int, n bigint")
    return counted.groupBy("bucket", "kind").agg(F.sum("n").alias("n"))


def log_odds(background: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Scores per bucket: log-odds where significantly above zero, else 0."""
    prior = PRIOR * (background + 0.01) / (background + 0.01).sum()
    n1, n0 = toxic.sum() + PRIOR, clean.sum() + PRIOR
    y1, y0 = toxic + prior, clean + prior
    delta = np.log(y1 / (n1 - y1)) - np.log(y0 / (n0 - y0))
    # Likelihood ratio of two rates against one, which holds for tokens one class never uses.
    pooled = (y1 + y0) / (n1 + n0)
    ratio = 2 * (y1 * np.log(y1 / (n1 * pooled)) + y0 * np.log(y0 / (n0 * pooled)))
    return np.where((delta >= LEAST) & (ratio >= SIGNIFICANT) & (toxic >= 2), delta, 0.0).astype(np.float32)


def maximal_segments(at: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` of a sequence, in linear time.

    ``at`` are the places of the positive ``scores``; every other place costs ``drift``.
    """
    # Each candidate: first, last, total before it, total up to its end.
    found: list[tuple[int, int, float, float]] = []
    total, place = 0.0, -1
    for p, s in zip(at, scores):
        total -= drift * (p - place - 1)
        first, left, total, place = p, total, total + s, p
        while found:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= total:
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
        found.append((first, p, left, total))
    return [(a, b, r - l) for a, b, l, r in found]


@dataclass
class Model:
    """Everything the scan needs; ``weights`` has ``BUCKETS`` entries whatever the corpus."""

    weights: np.ndarray
    rate: float = 0.0  # constant of the extreme-value law
    offset: float = -30.0
    slope: float = 0.0

    def scorer(self) -> Scorer:
        return Scorer(self)

    def excess(self, score: float, words: int) -> float:
        """Score beyond what a clean text of this length reaches by chance (0: not significant)."""
        return max(0.0, score - math.log1p(self.rate * words))

    def probability(self, total: float) -> float:
        x = self.offset + self.slope * total
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) if self.slope else 0.0


class Scorer(dict):
    """Word scores, each worked out once."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        a, b = buckets_of(word)
        score = self[word] = float(max(self.model.weights[a], self.model.weights[b])) if a >= 0 else 0.0
        return score

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and the maximal segments in words."""
        if len(self) > WORDS:
            self.clear()
        words = text.lower().split()
        scores = np.fromiter(map(self.__getitem__, words), np.float64, len(words))
        at = np.flatnonzero(scores > 0)
        return len(words), maximal_segments(at.tolist(), scores[at].tolist()) if len(at) else []

    def passages(self, text: str) -> tuple[list[tuple[int, int, float]], float]:
        """Significant passages ``(first word, end word, excess)`` and the text's score."""
        words, segments = self.segments(text)
        kept = [(a, b + 1, e) for a, b, s in segments if (e := self.model.excess(s, words)) > 0]
        return kept, self.model.probability(sum(e for _, _, e in kept))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a lightly damped logistic fit."""
    w, features = np.zeros(2), np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        damp = np.diag([1e-3, 1e-3])
        step = np.linalg.solve(features.T @ (features * (p * (1 - p))[:, None]) + damp, features.T @ (p - y) + damp @ w)
        w -= np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def fit(documents: DataFrame, labels: DataFrame, use: Column, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents that ``use`` (a condition on ``doc_id``) allows.

    The background rates come from all documents.  What reaches the driver is bounded: counts of
    ``BUCKETS`` buckets, and one short row per sampled document.
    """
    chosen = durable(labelled_sample(documents, labels, "toxic", use, sample), "toxicity-sample")
    counts = token_counts(keyed_texts(documents), F.lit(2)).unionByName(token_counts(chosen, F.col("label")))
    table = counts.toArrow()
    by_kind = np.zeros((3, BUCKETS))
    by_kind[table.column("kind").to_numpy(), table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    model = Model(log_odds(by_kind[2], by_kind[0], by_kind[1]))
    if not by_kind[1].sum() or not by_kind[0].sum():
        return model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            rows = [scorer.segments(t) for t in batch.column("text").to_pylist()]
            scores = [[s for _, _, s in segments] for _, segments in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([n for n, _ in rows], pa.int64()), pa.array(scores, pa.list_(pa.float64()))],
                ["label", "words", "scores"],
            )

    rows = chosen.mapInArrow(run, "label int, words bigint, scores array<double>").collect()
    clean = [(r.words, max(r.scores, default=0.0)) for r in rows if r.label == 0 and r.words]
    # Under the law, rate * words * exp(-best) is exponential with mean 1 in clean texts.
    model.rate = len(clean) / max(sum(n * math.exp(-s) for n, s in clean), 1e-9) if clean else 0.0
    totals = np.array([sum(model.excess(s, r.words) for s in r.scores) for r in rows])
    model.offset, model.slope = _logistic(totals, np.array([float(r.label) for r in rows]))
    return model


RESULT = "doc_id bigint, score double, passages array<struct<first:int,end:int,excess:double>>"


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, passages`` of every whole text; passages are in words, end exclusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("excess", pa.float64())]))
        for batch in batches:
            rows = [scorer.passages(t) for t in batch.column("text").to_pylist()]
            passages = [[{"first": a, "end": b, "excess": e} for a, b, e in found] for found, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s for _, s in rows], pa.float64()), pa.array(passages, kind)],
                ["doc_id", "score", "passages"],
            )

    return keyed_texts(documents).mapInArrow(run, RESULT)


def drop_toxic(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, whose score is below ``threshold``."""

    schema = documents.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            keep = [scorer.passages(t or "")[1] < threshold for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, schema)


def toxicity_digests(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores with the folds of the query: every third key, by its CRC-32, is held out."""
    model = fit(documents, labels, fold(F.col("doc_id"), 3) != 1)
    return score_documents(documents, model).select(
        "doc_id",
        (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "passages",
    )
