"""Tokenizers from byte-level vocabulary files, as Arrow functions on columns.

Tokens of such vocabularies may reach across a line start (a run of newlines is one token) and end inside a
character.  A position in characters counts the characters begun so far, and texts of tokens are their bytes
read as UTF-8, with U+FFFD for what a cut leaves of a character.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the white space of the vocabularies' pretoken pattern.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
# Characters of one text encoded at a time; texts are cut where a token surely ends.
PART_CHARS = 1 << 18
_SURE = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")


def _byte_of() -> dict[str, int]:
    """The byte that each printable character of byte-level vocabularies stands for."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class Encoded:
    """The tokens of one text."""

    def __init__(self, vocabulary: "Vocabulary", text: str, ids: np.ndarray | None = None):
        self.vocabulary, self.text, self.raw = vocabulary, text, text.encode("utf-8")
        self.ids = vocabulary.ids(text) if ids is None else ids
        self.byte_ends = np.cumsum(vocabulary.lengths[self.ids])
        if (int(self.byte_ends[-1]) if len(self.ids) else 0) != len(self.raw):
            raise ValueError("tokens do not rejoin to the text")

    def __len__(self) -> int:
        return len(self.ids)

    def measure(self) -> None:
        """Where tokens end and characters begin."""
        begins = (np.frombuffer(self.raw, np.uint8) & 0xC0) != 0x80
        self.char_begins = np.flatnonzero(begins)
        self.char_ends = np.concatenate([[0], np.cumsum(begins)[self.byte_ends - 1]])

    def part(self, start: int, end: int) -> str:
        at = [0 if k <= 0 else int(self.byte_ends[min(k, len(self)) - 1]) for k in (start, end)]
        return self.raw[at[0] : at[1]].decode("utf-8", "replace")

    def prefix_count(self, offset: int) -> int:
        """Number of tokens of the first ``offset`` characters encoded alone.

        They are the tokens of the whole text up to the white space before the offset, which alone is
        encoded anew: a token ends where white space begins, whatever follows.
        """
        at = offset
        while at and self.text[at - 1] in WHITE:
            at -= 1
        begin = int(self.char_begins[at]) if at < len(self.char_begins) else len(self.raw)
        return int(np.searchsorted(self.byte_ends, begin, "right")) + self.vocabulary.blanks(self.text[at:offset])


class Vocabulary:
    """A byte-level vocabulary; strings of special tokens are plain text."""

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(source)
        before = spec.get("pre_tokenizer") or {}
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("not a plain byte-level vocabulary")
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        byte_of = _byte_of()
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = bytes(map(byte_of.__getitem__, token))
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.blank_counts: dict[str, int] = {}

    def ids(self, text: str) -> np.ndarray:
        parts, at = [], 0
        while len(text) - at > PART_CHARS:
            cut = _SURE.search(text, at + PART_CHARS)
            if not cut:
                break
            parts.append(text[at : cut.start()])
            at = cut.start()
        found = self.tokenizer.encode_batch_fast([*parts, text[at:]], add_special_tokens=False)
        return np.concatenate([np.array(e.ids, np.int64) for e in found])

    def blanks(self, white: str) -> int:
        if white not in self.blank_counts:
            self.blank_counts[white] = len(self.ids(white))
        return self.blank_counts[white]

    def spans(self, text: str | None, breaks: list[int], size: int, overlap: int, tolerance: int) -> list[tuple[int, int, str]]:
        """Chunks of ``size`` tokens that end at the nearest break within the tolerance, each begun ``overlap`` before the last end."""
        if not text:
            return []
        tokens = Encoded(self, text)
        tokens.measure()
        ends, n, start, found = tokens.char_ends, len(tokens), 0, []
        while start < n:
            end = min(start + size, n)
            if end < n and breaks:
                low, high, target = int(ends[max(0, end - tolerance)]), int(ends[min(n, end + tolerance)]), int(ends[end])
                at = bisect_left(breaks, target)
                near = [b for b in breaks[max(0, at - 1) : at + 1] if low <= b <= high]
                if near:
                    best = tokens.prefix_count(min(near, key=lambda b: (abs(b - target), b)))
                    # A break that would not move the next chunk on is not taken.
                    end = best if best - overlap > start else end
            found.append((start, end, tokens.part(start, end)))
            if end >= n:
                break
            start = max(end - overlap, 0)
        return found


@lru_cache(maxsize=4)
def _vocabulary(source: str) -> Vocabulary:
    """Kept by a Python worker from task to task."""
    return Vocabulary(source)


def _values(array: pa.Array) -> Iterator:
    """The values of an Arrow array, lists of numbers as views of their memory."""
    if not pa.types.is_list(array.type):
        yield from array.to_pylist()
        return
    flat, offsets, known = array.values.to_numpy(zero_copy_only=False), array.offsets.to_pylist(), array.is_valid().to_pylist()
    for begin, end, there in zip(offsets, offsets[1:], known):
        yield flat[begin:end] if there else None


@dataclass(frozen=True)
class VocabularyTokenizer:
    """Column functions of the vocabulary of one file, which the driver reads and the tasks get with the job."""

    name: str
    source: str

    def _function(self, returns: str, compute: Callable) -> Callable[..., Column]:
        source = self.source

        def run(*arrays: pa.Array) -> pa.Array:
            vocabulary = _vocabulary(source)
            rows = zip(*(_values(a) for a in arrays))
            return pa.array([None if row[0] is None else compute(vocabulary, *row) for row in rows], type_of)

        type_of = _ARROW[returns]
        return F.arrow_udf(run, returns)

    def encode(self, text: Column) -> Column:
        """Text to ``ARRAY<INT>`` token ids."""
        return self._function("array<int>", lambda v, t: v.ids(t).astype(np.int32) if t else [])(text)

    def count(self, text: Column) -> Column:
        return self._function("int", lambda v, t: len(v.ids(t)) if t else 0)(text)

    def decode(self, ids: Column) -> Column:
        """Token ids, of which any slice may be given, to text."""
        return self._function("string", lambda v, ids: b"".join(map(v.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace"))(ids)

    def token_ends(self, text: Column, ids: Column | None = None) -> Column:
        """Characters begun up to the end of each token, as ``ARRAY<INT>``; ``ids`` are those of the text, if at hand."""

        def ends(vocabulary: Vocabulary, text: str, ids: np.ndarray | None = None) -> np.ndarray | list[int]:
            if not text:
                return []
            tokens = Encoded(vocabulary, text, ids)
            tokens.measure()
            return tokens.char_ends[1:].astype(np.int32)

        return self._function("array<int>", ends)(*([text] if ids is None else [text, ids]))

    def chunk_rows(self, df: DataFrame, text: str, breaks: str, size: int, overlap: int, tolerance: int) -> DataFrame:
        """One row per chunk: the other columns, ``chunk_index, total_chunks, token_start, token_end`` and the chunk's ``text``."""
        source, kept = self.source, [f for f in df.schema if f.name not in (text, breaks)]
        schema = T.StructType([*kept, *CHUNK_FIELDS])

        def rows(vocabulary: Vocabulary, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            columns = [batch.column(f.name) for f in kept]
            for n, row in enumerate(zip(batch.column(text).to_pylist(), batch.column(breaks).to_pylist())):
                found = vocabulary.spans(row[0], row[1] or [], size, overlap, tolerance)
                if found:
                    count = len(found)
                    repeated = [c.take(pa.array([n] * count)) for c in columns]
                    starts, ends, texts = zip(*found)
                    numbers = [pa.array(x, pa.int32()) for x in (range(count), [count] * count, starts, ends)]
                    yield pa.RecordBatch.from_arrays([*repeated, *numbers, pa.array(texts, pa.string())], schema.names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary = _vocabulary(source)
            for batch in batches:
                yield from rows(vocabulary, batch)

        return df.mapInArrow(run, schema)


CHUNK_FIELDS = [T.StructField(name, T.IntegerType()) for name in ("chunk_index", "total_chunks", "token_start", "token_end")] + [
    T.StructField("text", T.StringType())
]
_ARROW = {
    "int": pa.int32(),
    "string": pa.string(),
    "array<int>": pa.list_(pa.int32()),
}


def vocabulary_tokenizer(name: str) -> VocabularyTokenizer:
    """The tokenizer of a name ``vocabulary:file=<path of a byte-level vocabulary>``."""
    kind, _, settings = name.partition(":")
    path = dict(s.partition("=")[::2] for s in settings.split(",")).get("file")
    if kind != "vocabulary" or not path:
        raise ValueError(f"not a vocabulary tokenizer: {name!r}; give vocabulary:file=<path>")
    with open(path, encoding="utf-8") as file:
        source = file.read()
    _vocabulary(source)
    return VocabularyTokenizer(name, source)
