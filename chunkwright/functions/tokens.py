"""Lossless tokens as column expressions.

A token is a newline, or a word with the blanks before it, or a run of blanks at
the end of a line.  Tokens rejoin to exactly the text they came from and never
reach across the start of a line, so a prefix that ends at a line start has the
same tokens as that prefix tokenized alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkwright.functions.vocabulary import VocabularyTokenizer, vocabulary_tokenizer

# Fixed value: the token pattern, read alike by Java and RE2.
TOKEN_PATTERN = r"\n|[ \t\r\f]*[^ \t\r\f\n]+|[ \t\r\f]+"


def encode(text: Column) -> Column:
    """Text to ``ARRAY<STRING>`` tokens."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def decode(tokens: Column, start: Column | int = 0, end: Column | int | None = None) -> Column:
    """Tokens ``[start, end)`` back to text."""
    start = F.lit(start) if isinstance(start, int) else start
    end = F.size(tokens) if end is None else F.lit(end) if isinstance(end, int) else end
    return F.array_join(F.slice(tokens, start + 1, end - start), "")


def count_tokens(text: Column) -> Column:
    """Number of tokens of a text."""
    return F.size(encode(text))


@dataclass(frozen=True)
class Tokenizer:
    """A named tokenizer; the token texts must rejoin to the text.

    ``encode`` maps a text column to its array of token texts, ``encode_pieces`` an array
    of texts to an array of such arrays.
    """

    name: str
    encode: Callable[[Column], Column]
    encode_pieces: Callable[[Column], Column]


_registry: dict[str, Tokenizer] = {}


def register_tokenizer(
    name: str,
    encode: Callable[[Column], Column] | None = None,
    encode_pieces: Callable[[Column], Column] | None = None,
) -> Tokenizer:
    """Make a tokenizer available by name.

    Give ``encode`` if it is built from column functions.  A vocabulary-based tokenizer
    comes as ``encode_pieces``, an Arrow-batched ``pandas_udf`` from ``array<string>`` to
    ``array<array<string>>``, because such functions do not run inside a lambda.
    """
    if encode is None and encode_pieces is None:
        raise ValueError("give encode or encode_pieces")
    pieces = encode_pieces or (lambda texts: F.transform(texts, encode))
    single = encode or (lambda text: F.get(encode_pieces(F.array(text)), F.lit(0)))
    _registry[name] = Tokenizer(name, single, pieces)
    return _registry[name]


LOSSLESS = register_tokenizer("lossless", encode)


def get_tokenizer(name: str | Tokenizer | VocabularyTokenizer = "lossless") -> Tokenizer | VocabularyTokenizer:
    """Look a tokenizer up; an unknown name is an error.

    ``vocabulary:file=<path>`` is the byte-level vocabulary of a file.
    """
    if isinstance(name, Tokenizer | VocabularyTokenizer):
        return name
    if name.startswith("vocabulary:"):
        return vocabulary_tokenizer(name)
    if name not in _registry:
        raise ValueError(f"unknown tokenizer {name!r}; known: {sorted(_registry)}")
    return _registry[name]
