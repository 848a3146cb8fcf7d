"""Byte-level BPE encoding and decoding through a pair occurrence index.

Every pair of neighbouring symbols is mapped to all its positions among the distinct
pretokens at hand.  Active ranks are applied in ascending order, each at all its positions
at once; only the lists of pairs beside a merge change.

Null and empty texts have no ids and decode to the empty text.  Repeated rows and null
``doc_id`` are encoded like any other row.  Other columns are ignored by the digests and
kept by ``encode`` and ``decode``, which name their result column.  An empty table gives an empty one; a very long
text is encoded whole, each of its distinct pretokens once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright.llm.pretokens import PieceEncoder, read_vocabulary, special_tokens
from chunkwright.llm.shared import keyed_texts, text_parts

# Bytes of text worked on at once; bounds a task's memory.
STEP_BYTES = 2 << 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Bpe:
    """Merges and tokens of one vocabulary."""

    def __init__(self, vocabulary: str):
        model = json.loads(vocabulary)["model"]
        ids, alphabet = model["vocab"], byte_alphabet()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int64)
        self.right = np.array([ids[b] for _, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.size = max(ids.values()) + 1
        keys = self.left * self.size + self.right
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]
        self.byte_ids = np.array([ids[c] for c in alphabet], np.int64)
        back = {c: b for b, c in enumerate(alphabet)}
        self.special = special_tokens(vocabulary)
        self.token_bytes = [b""] * (max([self.size - 1, *self.special.values()]) + 1)
        for token, i in ids.items():
            self.token_bytes[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode("utf-8")

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct, non-empty pretokens, end to end, and their number per pretoken."""
        raw = [w.encode("utf-8", "replace") for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        ends = np.cumsum(lengths)
        following = np.arange(1, len(symbols) + 1)
        following[ends - 1] = -1
        previous = np.arange(-1, len(symbols) - 1)
        previous[ends - lengths] = -1
        positions: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            key = symbols[at] * self.size + symbols[following[at]]
            slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[slot] == key
            at, rank = at[known], self.by_key[slot[known]]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = (np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist()
            for begin, end in zip([0, *cuts], [*cuts, len(at)]) if len(at) else ():
                r = int(rank[begin])
                if r in positions:
                    positions[r].append(at[begin:end])
                else:
                    positions[r] = [at[begin:end]]
                    heapq.heappush(active, r)

        if len(self.keys):
            add(np.flatnonzero(following >= 0))
        while active:
            rank = heapq.heappop(active)
            a, b = self.left[rank], self.right[rank]
            at = np.unique(np.concatenate(positions.pop(rank)))
            after = following[at]
            # Entries whose symbols have changed since they were listed are void.
            at = at[(after >= 0) & (symbols[at] == a) & (symbols[after] == b)]
            if a == b:  # in a run of equal symbols the leftmost pairs go first
                used: set[int] = set()
                kept = []
                for p in at.tolist():
                    if p not in used:
                        kept.append(p)
                        used.add(int(following[p]))
                at = np.array(kept, np.int64)
            if not len(at):
                continue
            after = following[at]
            symbols[at] = self.merged[rank]
            symbols[after] = -1
            beyond = following[after]
            following[at] = beyond
            linked = beyond >= 0
            previous[beyond[linked]] = at[linked]
            before = previous[at]
            add(np.concatenate([before[before >= 0], at[linked]]))
        alive = symbols >= 0
        counts = np.add.reduceat(alive, ends - lengths, dtype=np.int64)
        return symbols[alive].astype(np.int32), counts

    def encoder(self) -> PieceEncoder:
        return PieceEncoder(self.encode_words, self.special)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def encode(documents: DataFrame, vocabulary_path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add the array column ``into`` with the ids of the column ``text``."""
    vocabulary = read_vocabulary(vocabulary_path)
    schema = T.StructType([f for f in documents.schema if f.name != into]).add(into, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Bpe(vocabulary).encoder()
        for batch in (part for whole in batches for part in text_parts(whole, text, STEP_BYTES)):
            flat, counts = encoder.encode(t or "" for t in batch.column(text).to_pylist())
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            columns = [batch.column(f.name) for f in schema if f.name != into]
            ids = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*columns, ids], [f.name for f in schema])

    return documents.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary_path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """Add the column ``into`` with the text of the array column ``ids`` (null: empty)."""
    vocabulary = read_vocabulary(vocabulary_path)
    schema = T.StructType([f for f in encoded.schema if f.name != into]).add(into, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        for batch in batches:
            texts = [bpe.decode(row or []) for row in batch.column(ids).to_pylist()]
            columns = [batch.column(f.name) for f in schema if f.name != into]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [f.name for f in schema])

    return encoded.mapInArrow(run, schema)


DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def round_trip(documents: DataFrame, vocabulary_path: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text in one pass; return digests of ids and decoded text.

    ``with_ids`` adds the column ``ids``.
    """
    vocabulary = read_vocabulary(vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        encoder = bpe.encoder()
        decimal = [str(i) for i in range(len(bpe.token_bytes))]
        for batch in (part for whole in batches for part in text_parts(whole, "text", STEP_BYTES)):
            flat, counts = encoder.encode(batch.column("text").to_pylist())
            ends = np.cumsum(counts).tolist()
            hashed, decoded, begin = [], [], 0
            for end in ends:
                ids = flat[begin:end].tolist()
                begin = end
                hashed.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(hashed, pa.string()),
                "decoded_sha256": pa.array(decoded, pa.string()),
            }
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return keyed_texts(documents).mapInArrow(run, DIGEST + (", ids array<int>" if with_ids else ""))
