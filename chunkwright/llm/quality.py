"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is its counts of neighbouring byte pairs, hashed into ``TERMS`` terms and weighted by
log frequency and by inverse document frequency over the whole corpus.  A truncated singular value
decomposition of at most ``SAMPLE`` labelled documents spans the latent space; their vectors are
broadcast (``SAMPLE`` x ``RANK`` numbers at most), every document is compared with all of them in
exact blocked cosine products, and the nearest vote with their similarity as weight.  Votes are
divided by the size of their class in the sample, so that the rarer class is heard.

Null and empty texts, and all texts when there are no labels, get the share of label 1 in the
sample (0.5 without labels).  Repeated rows score alike; other columns are ignored.
Of labelled texts that are equally near those vote that the selection of the nearest happens to keep, so equal texts with different
labels may vote either way.  Very long texts are weighed whole; an empty ``documents`` gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.labelled import fold, labelled_sample
from chunkwright.llm.shared import keyed_texts

TERMS = 2048
RANK = 64
# Labelled documents that span the space and vote, at most.
SAMPLE = 4096
NEIGHBOURS = 15
SHARPNESS = 8.0
THRESHOLD = 0.3
BLOCK = 1024
# Byte pairs to terms: a fixed multiplicative hash.
_TERM = ((np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 11)).astype(np.int64)


def term_counts(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8).astype(np.uint16)
    if len(raw) < 2:
        return np.zeros(TERMS, np.int64)
    return np.bincount(_TERM[(raw[:-1] << np.uint16(8)) | raw[1:]], minlength=TERMS)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per term and documents in all, over the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total += term_counts(text) > 0
                n += 1
        at = np.arange(TERMS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.append(total, n), pa.int64())], ["term", "n"])

    counted = texts.select("text").mapInArrow(run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(TERMS + 1, np.int64)
    for term, n in counted.collect():  # TERMS + 1 rows at most
        out[term] = n
    return out[:TERMS], int(out[TERMS])


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray  # TERMS x rank
    vectors: np.ndarray  # rank x labelled
    labels: np.ndarray
    base: float

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        """Unit rows of weighted terms."""
        rows = (np.log1p(counts) * self.idf).astype(np.float32)
        norm = np.linalg.norm(rows, axis=1, keepdims=True)
        return rows / np.where(norm > 0, norm, 1)

    def latent(self, counts: np.ndarray) -> np.ndarray:
        rows = self.weighted(counts) @ self.axes
        norm = np.linalg.norm(rows, axis=1, keepdims=True)
        return rows / np.where(norm > 0, norm, 1)

    def vote(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled documents of each row."""
        scores = np.full(len(counts), self.base)
        if not self.vectors.shape[1]:
            return scores
        rows = self.latent(counts)
        near = min(NEIGHBOURS, self.vectors.shape[1])
        shares = np.array([1 - self.base, self.base])
        for i in range(0, len(rows), BLOCK):
            cosine = rows[i : i + BLOCK] @ self.vectors
            top = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            weight = np.maximum(np.take_along_axis(cosine, top, 1), 0).astype(np.float64) ** SHARPNESS
            label = self.labels[top]
            weight /= np.maximum(shares[label], 1e-9)
            total = weight.sum(1)
            voted = total > 1e-12
            scores[i : i + BLOCK][voted] = ((weight * label).sum(1) / np.where(voted, total, 1))[voted]
        scores[counts.sum(1) == 0] = self.base
        return np.round(scores, 9)


def _axes(rows: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration from a fixed start."""
    rank = min(rank, *rows.shape)
    start = np.random.default_rng(7).standard_normal((rows.shape[1], min(rank + 16, rows.shape[1]))).astype(np.float32)
    basis = np.linalg.qr(start)[0]
    for _ in range(6):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    _, _, right = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ right.T)[:, :rank].astype(np.float32)


def fit(documents: DataFrame, labels: DataFrame, use: Column, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents that ``use`` (a condition on ``doc_id``) allows.

    Their ``TERMS`` counts each, a bounded table, come to the driver for the decomposition.
    """
    frequencies, n = document_frequencies(keyed_texts(documents))
    idf = np.log((1 + n) / (1 + frequencies)) + 0.1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [term_counts(t).astype("<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], ["doc_id", "label", "counts"])

    chosen = labelled_sample(documents, labels, "quality", use, sample)
    table = chosen.mapInArrow(run, "doc_id bigint, label int, counts binary").toPandas()
    table = table.sort_values(["doc_id", "counts"]).drop_duplicates("doc_id")
    counts = np.array([np.frombuffer(c, "<i4") for c in table["counts"]], np.float32).reshape(-1, TERMS)
    known = table["label"].to_numpy(np.int64)
    base = float(known.mean()) if len(known) else 0.5
    model = Model(idf, np.zeros((TERMS, 0), np.float32), np.zeros((0, 0), np.float32), known, base)
    if len(known):
        model.axes = _axes(model.weighted(counts), RANK)
        model.vectors = model.latent(counts).T.copy()
    return model


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every whole text.  The model goes with the job, which Spark broadcasts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                counts = np.array([term_counts(t) for t in part.column("text").to_pylist()], np.float32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.vote(counts), pa.float64())], ["doc_id", "score"])

    return keyed_texts(documents).mapInArrow(run, "doc_id bigint, score double")


def quality_digests(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores with the folds of the query: every fifth key, by its CRC-32, is held out."""
    model = fit(documents, labels, fold(F.col("doc_id"), 5) != 0)
    return score_documents(documents, model).select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
