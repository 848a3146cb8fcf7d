"""Alignment of the tokens of two tokenizers over the same text.

Every text is encoded by a byte-level vocabulary (A: a blank and the text) and by a piece model (B: the
text, before which it adds a blank).  Ends of tokens in bytes come in two steps:

1. Coarse cuts: the character offsets that the tokenizers library gives, turned into byte offsets, and
   the byte spans of sentencepiece's proto.
2. Refinement: several A tokens may share the offsets of one character of several bytes, and B's byte
   tokens stand at its start but for the last.  Their ends follow from the bytes that the tokens decode to.

Places where a token of A and one of B both end cut the tokens into groups.  Tokens whose bytes
overlap are linked; each link is one stretch between neighbouring ends.  How many links of the corpus
hold a pair of ids is counted over all texts.  Documents keep their distinct pairs and how often they
hold them, so counts meet documents in one join on the pair: by broadcast while the pairs are at
most ``BROADCAST_PAIRS`` (counted before), by sort-merge beyond.

Texts that are null or empty, or that one of the tokenizers does not give back byte for byte, have no
tokens: their numbers are zero and ``groups_sha256`` is empty.  Strings of special tokens inside texts are
plain text.  Null and repeated ``doc_id`` and repeated rows are rows like any other; all other columns
are ignored by the digests and kept by ``align``.  An empty table gives an empty table.  Texts are cut before
blanks at which both tokenizers start anew, and every distinct piece is encoded and aligned once per worker, so
a very long text needs no more memory than its pieces.  Of several ids of A that are linked equally often with
an id of B all are the best.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright.llm.bpe import byte_alphabet
from chunkwright.llm.pretokens import BLANK, read_vocabulary
from chunkwright.llm.shared import ragged, text_parts
from chunkwright.session import durable

# Bytes of text worked on at a time.
STEP_BYTES = 1 << 20
# Distinct pieces, and their characters, kept per worker before the store starts anew; bounds memory, not results.
PIECES, PIECE_CHARS = 400_000, 16 << 20
# Pairs of 24 bytes each that a broadcast may hold.
BROADCAST_PAIRS = 2_000_000
# Before such a blank a token of either kind ends; a last blank stays with what stands before it.
_SURE = re.compile(f"(?<=[^{BLANK}])(?= .)", re.DOTALL)
_UNSURE = re.compile(f"[{BLANK}] ")
_ASCII_RUNS = ("  ", "\n ", "\t ", "\r ", "\x0b ", "\x0c ")
_LAST_BLANK = re.compile(f"[{BLANK}]\\Z")
_BLANK_PIECE = "▁"
# Characters of pieces encoded in one row.
BLOCK_CHARS = 1 << 14


def text_pieces(text: str) -> list[str]:
    """The pieces of a blank and the text that both tokenizers encode alike alone and in place, without their leading blanks."""
    if text[0] == " " or text[-1] == " " or any(r in text for r in _ASCII_RUNS) or not text.isascii() and _UNSURE.search(text):
        return [piece[1:] for piece in _SURE.split(f" {text}")]
    return text.split(" ")


class Spans:
    """Tokens of several parts, end to end: ids, ends in bytes from the first part on, and whether each part is whole."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, counts: np.ndarray, whole: np.ndarray):
        self.ids, self.ends, self.counts, self.whole = ids, ends, counts, whole

    def only(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        taken = np.repeat(parts, self.counts)
        return self.ids[taken], self.ends[taken]


def _refined(coarse: np.ndarray, unsure: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Ends in each part, of which unsure ones are counted from the decoded bytes."""
    total = np.cumsum(lengths)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    before = np.concatenate([[0], total])[first]
    return np.where(unsure, total - np.repeat(before, counts), coarse)


class Aligner:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, vocabulary: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(vocabulary)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        back = {c: b for b, c in enumerate(byte_alphabet())}
        ids = json.loads(vocabulary)["model"]["vocab"]
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in ids.items():
            self.a_bytes[i] = bytes(map(back.__getitem__, token))
        self.b = SentencePieceProcessor(model_proto=model)
        self.b_size = self.b.vocab_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.b_size)]
        if any(_BLANK_PIECE in p.lstrip(_BLANK_PIECE) for p in pieces):
            raise ValueError("the piece model has pieces with a blank after other characters")
        self.b_is_byte = np.array([self.b.is_byte(i) for i in range(self.b_size)])
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b_is_byte[i] else p.replace(_BLANK_PIECE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_lengths = np.array([len(b) for b in self.a_bytes], np.int64)
        self.b_lengths = np.array([len(b) for b in self.b_bytes], np.int64)
        # Decimal ids before a comma, the bar and the semicolon of a list of groups.
        self.told = [f"{i}{mark}" for i in range(max(len(self.a_bytes), self.b_size)) for mark in ",|;"]

    def _spans(self, table: list[bytes], parts: list[bytes], ids: np.ndarray, counts: np.ndarray, ends: np.ndarray) -> Spans:
        whole, at, flat = [], 0, ids.tolist()
        for part, count in zip(parts, counts.tolist()):
            whole.append(b"".join(map(table.__getitem__, flat[at : at + count])) == part)
            at += count
        sizes = np.array([len(p) for p in parts], np.int64)
        return Spans(ids, ends + np.repeat(np.cumsum(sizes) - sizes, counts), counts, np.array(whole, bool))

    def a_spans(self, parts: list[str], raw: list[bytes]) -> Spans:
        found = self.a.encode_batch(parts, add_special_tokens=False)
        counts = np.array([len(e) for e in found], np.int64)
        n = int(counts.sum())
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.int64, n)
        offsets = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in found)), np.int64, 2 * n)
        begin, end = offsets[::2], offsets[1::2]
        # A token that ends within a character shares it with the next one.
        shared = np.zeros(n, bool)
        shared[:-1] = begin[1:] < end[:-1]
        last = np.cumsum(counts)[counts > 0] - 1
        shared[last] = False
        coarse = end.copy()
        at = 0
        for part, data, count in zip(parts, raw, counts.tolist()):
            if len(part) < len(data):  # characters of several bytes
                codes = np.frombuffer(part.encode("utf-32-le"), np.uint32)
                width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
                coarse[at : at + count] = np.concatenate([[0], np.cumsum(width)])[end[at : at + count]]
            at += count
        return self._spans(self.a_bytes, raw, ids, counts, _refined(coarse, shared, self.a_lengths[ids], counts))

    def b_spans(self, parts: list[str], raw: list[bytes]) -> Spans:
        found = [p.pieces for p in self.b.encode([p[1:] for p in parts], return_type="proto", num_threads=1)]
        counts = np.array([len(p) for p in found], np.int64)
        n = int(counts.sum())
        ids = np.fromiter((p.id for pieces in found for p in pieces), np.int64, n)
        # Spans do not count the blank that the model adds.
        ends = np.fromiter((p.end for pieces in found for p in pieces), np.int64, n) + 1
        return self._spans(self.b_bytes, raw, ids, counts, _refined(ends, self.b_is_byte[ids], self.b_lengths[ids], counts))

    def align(self, pieces: list[str]) -> "Aligned":
        """Both tokens of every piece after a blank.  Pieces are encoded in rows, as they would stand in a text."""
        blocks, chars = [0], 0
        for n, piece in enumerate(pieces[:-1], 1):
            chars += len(piece)
            # After white space the next piece would not begin anew.
            if chars > BLOCK_CHARS or _LAST_BLANK.search(piece):
                blocks.append(n)
                chars = 0
        sizes = np.diff([*blocks, len(pieces)])
        found = self._rows(pieces, sizes)
        if not found[2].all():
            # Only the pieces that are not given back have no tokens.
            found = self._rows(pieces, np.repeat(np.where(found[2], sizes, 1), np.where(found[2], 1, sizes)))
        return self._aligned(pieces, *found)

    def _rows(self, pieces: list[str], sizes: np.ndarray) -> tuple[Spans, Spans, np.ndarray, np.ndarray]:
        at = [0, *np.cumsum(sizes).tolist()]
        parts = [" " + " ".join(pieces[i:j]) for i, j in zip(at, at[1:])]
        raw = [p.encode() for p in parts]
        one, two = self.a_spans(parts, raw), self.b_spans(parts, raw)
        return one, two, one.whole & two.whole, sizes

    def _aligned(self, pieces: list[str], one: Spans, two: Spans, whole: np.ndarray, sizes: np.ndarray) -> "Aligned":
        (a, a_end), (b, b_end) = one.only(whole), two.only(whole)
        cuts = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        cuts = cuts[np.concatenate([cuts[1:] != cuts[:-1], [True]])[: len(cuts)]]
        at_a, at_b = np.searchsorted(a_end, cuts), np.searchsorted(b_end, cuts)
        pairs = b[at_b] * len(self.a_bytes) + a[at_a]
        common = cuts[(a_end[at_a] == cuts) & (b_end[at_b] == cuts)]
        group_a, group_b = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        # The ids as they are listed: of every group those of A, then those of B.
        listed = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = (np.concatenate([g[1:] != g[:-1], [True]])[: len(g)] for g in (group_a, group_b))
        listed[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 3 * a + last_a
        listed[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = 3 * b + 2 * last_b
        ends = np.cumsum([1 + len(p if p.isascii() else p.encode()) for p in pieces])
        bounds = [np.searchsorted(x, ends, "right") for x in (a_end, b_end, common, cuts)]
        counts = np.stack([np.diff(x, prepend=0) for x in bounds])
        strings = list(map(self.told.__getitem__, listed.tolist()))
        at = [0, *(bounds[0] + bounds[1]).tolist()]
        told = ["".join(strings[i:j])[:-1] for i, j in zip(at, at[1:])]
        return Aligned(counts, told, pairs, np.repeat(whole, sizes))


class Aligned:
    """Per piece its ``counts`` (tokens of A and of B, groups, links), its groups, and its linked pairs, end to end."""

    def __init__(self, counts: np.ndarray, told: list[str], pairs: np.ndarray, whole: np.ndarray):
        self.counts, self.told, self.pairs, self.whole = counts, told, pairs, whole


class Store(dict):
    """Numbers pieces in the order of their first use and aligns each of them once."""

    def __init__(self, aligner: Aligner):
        super().__init__()
        self.aligner = aligner
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.fresh, self.chars = [], 0
        self.known = Aligned(np.zeros((4, 0), np.int64), [], np.zeros(0, np.int64), np.zeros(0, bool))

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        self.chars += len(piece)
        return number

    def _learn(self) -> None:
        pieces, self.fresh, known = self.fresh, [], self.known
        new, at = [], 0
        while at < len(pieces):
            end, chars = at, 0
            while end < len(pieces) and chars < STEP_BYTES:
                chars += len(pieces[end]) + 1
                end += 1
            new.append(self.aligner.align(pieces[at:end]))
            at = end
        every = [known, *new]
        self.known = Aligned(
            np.concatenate([x.counts for x in every], axis=1), [*known.told, *chain.from_iterable(x.told for x in new)],
            np.concatenate([x.pairs for x in every]), np.concatenate([x.whole for x in every]),
        )
        self.first = np.cumsum(self.known.counts[3]) - self.known.counts[3]

    def align(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, str, np.ndarray, np.ndarray]]:
        """Per text its counts, the digest of its groups, and its linked pairs with how often each is."""
        if len(self) > PIECES or self.chars > PIECE_CHARS:
            self.reset()
        rows = [list(map(self.__getitem__, text_pieces(t))) if t else [] for t in texts]
        if self.fresh:
            self._learn()
        known, none = self.known, np.zeros(0, np.int64)
        for row in rows:
            if not row or not known.whole[row].all():
                yield np.zeros(4, np.int64), "", none, none
                continue
            numbers, often = np.unique(np.array(row), return_counts=True)
            links = known.counts[3, numbers]
            pairs, place = np.unique(known.pairs[ragged(self.first[numbers], links)], return_inverse=True)
            times = np.bincount(place, np.repeat(often, links)).astype(np.int64)
            told = ";".join(map(known.told.__getitem__, row))
            yield known.counts[:, numbers] @ often, hashlib.sha256(told.encode()).hexdigest(), pairs, times


@lru_cache(maxsize=1)
def _store(vocabulary: str, model: bytes) -> Store:
    """Kept by a worker from task to task."""
    return Store(Aligner(vocabulary, model))


FOUND = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    + [T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))]
)


def align(documents: DataFrame, vocabulary_path: str, model_path: str, text: str = "text") -> DataFrame:
    """Add the struct ``alignment``: numbers of tokens, groups and links, the groups' digest, the linked pairs and how often each is.

    A pair is B's id times the number of A's ids, plus A's id.
    """
    vocabulary = read_vocabulary(vocabulary_path)
    with open(model_path, "rb") as file:
        model = file.read()
    kept = [f for f in documents.schema if f.name != "alignment"]
    schema = T.StructType([*kept, T.StructField("alignment", FOUND)])

    def step(store: Store, part: pa.RecordBatch) -> pa.RecordBatch:
        counts, told, pairs, times = zip(*store.align(part.column(text).to_pylist()))
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]), pa.int32())
        columns = [
            *(pa.array(x, pa.int64()) for x in np.stack(counts, axis=1)), pa.array(told, pa.string()),
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(pairs), pa.int64())),
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times), pa.int32())),
        ]
        return pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), pa.StructArray.from_arrays(columns, FOUND.names)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _store(vocabulary, model)
        for batch in batches:
            for part in text_parts(batch, text, STEP_BYTES):
                yield step(store, part)

    return documents.mapInArrow(run, schema)


def pair_statistics(links: DataFrame, a_size: int) -> DataFrame:
    """``pair, links, best`` of ``links (pair, times)``: links of the corpus, and whether no id of A has more with that id of B."""
    counts = durable(links.groupBy("pair").agg(F.sum("times").alias("links")), "pair-counts")
    keyed = counts.withColumn("b", F.expr(f"pair div {a_size}"))
    # One row per id of B, whose number the model bounds.
    most = keyed.groupBy("b").agg(F.max("links").alias("most"))
    return keyed.join(F.broadcast(most), "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def alignment_digests(documents: DataFrame, vocabulary_path: str, model_path: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Numbers of tokens, groups and links per document, and how common its links are in the corpus."""
    from tokenizers import Tokenizer

    a_size = Tokenizer.from_file(vocabulary_path).get_vocab_size()
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    found = align(rows, vocabulary_path, model_path).select("row", "doc_id", "alignment.*")
    found = durable(found, "alignments")
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), "l.times")
    statistics = durable(pair_statistics(links, a_size), "pair-statistics")
    side = F.broadcast(statistics) if statistics.count() <= broadcast_pairs else statistics.hint("merge")
    sums = links.join(side, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("links")).alias("count_sum")
    )
    none = F.lit(0).cast("bigint")
    return found.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
