"""Splitting text into the pretokens of a byte-level vocabulary, once per distinct piece.

A text is cut at blanks where a pretoken boundary is certain; each distinct piece is then
split and encoded once per task, however often it occurs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable

import numpy as np
import regex

from chunkwright.llm.shared import ragged

# The white space, and the pretoken pattern, of the byte-level vocabulary files.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRETOKEN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{BLANK}\p{{L}}\p{{N}}]+"
    rf"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
)
# A blank between white space (or the end) on either side may stand inside one pretoken.
_UNSURE = re.compile(f"[{BLANK}] (?:[{BLANK}]|$)")
_SURE = re.compile(f"(?<=[^{BLANK}])(?= )|(?= [^{BLANK}])")
_ASCII_RUNS = ("  ", " \n", " \t", " \r", " \x0b", " \x0c")
# Distinct pieces kept per task before the store starts anew; bounds memory, not results.
PIECES = 600_000


class _Index(dict):
    """Numbers keys in the order of their first use and remembers the new ones."""

    def __init__(self):
        self.fresh: list = []

    def __missing__(self, key):
        number = self[key] = len(self)
        self.fresh.append(key)
        return number

    def take(self) -> list:
        fresh, self.fresh = self.fresh, []
        return fresh


def _pieces(text: str) -> list:
    """Keys of the pieces: a string stands for itself after a blank, a 1-tuple for itself alone."""
    unsure = any(run in text for run in _ASCII_RUNS) or text.endswith(" ") or not text.isascii()
    if unsure and _UNSURE.search(text):
        return [p[1:] if p[0] == " " else (p,) for p in _SURE.split(text) if p]
    first, *rest = text.split(" ")
    return [(first,), *rest] if first else rest


class _Ragged:
    """Growing rows of ids, stored end to end."""

    def __init__(self):
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])

    def rows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[which]
        return self.flat[ragged(self.starts[which], lengths)], lengths


class PieceEncoder:
    """Encodes texts through ``encode_words``, which maps pretokens to ``(flat ids, lengths)``.

    ``special`` maps the texts of special tokens to their ids; they are found before all else.
    """

    def __init__(self, encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], special: dict[str, int]):
        self.encode_words = encode_words
        self.special = special
        found = "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))
        self.split_special = re.compile(f"({found})").split if special else None
        self.pattern = regex.compile(PRETOKEN)
        self._reset()

    def _reset(self) -> None:
        self.pieces, self.words = _Index(), _Index()
        self.piece_ids, self.word_ids = _Ragged(), _Ragged()

    def _keys(self, text: str) -> list:
        if self.special and any(s in text for s in self.special):
            keys = []
            for i, part in enumerate(self.split_special(text)):
                keys += [self.special[part]] if i % 2 else _pieces(part) if part else []
            return keys
        return _pieces(text) if text else []

    def _learn(self) -> None:
        """Encode the pieces met for the first time."""
        fresh = self.pieces.take()
        counts = np.zeros(len(fresh), np.int64)
        numbers: list[int] = []
        number, find = self.words.__getitem__, self.pattern.findall
        for i, key in enumerate(fresh):
            if isinstance(key, int):
                parts = [key]
            elif isinstance(key, tuple):
                parts = find(key[0])
            else:
                parts = [f" {key}"] if key.isalpha() else find(f" {key}")
            counts[i] = len(parts)
            numbers += map(number, parts)
        words = self.words.take()
        plain = [w for w in words if not isinstance(w, int)]
        flat, lengths = self.encode_words(plain) if plain else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        if len(plain) < len(words):  # special tokens stand for their own ids
            is_id = np.array([isinstance(w, int) for w in words])
            all_lengths = np.ones(len(words), np.int64)
            all_lengths[~is_id] = lengths
            at = np.cumsum(all_lengths) - all_lengths
            all_flat = np.zeros(int(all_lengths.sum()), np.int32)
            all_flat[at[is_id]] = [w for w in words if isinstance(w, int)]
            all_flat[ragged(at[~is_id], lengths)] = flat
            flat, lengths = all_flat, all_lengths
        self.word_ids.extend(flat, lengths)
        flat, lengths = self.word_ids.rows(np.array(numbers, np.int64))
        ends = np.concatenate([[0], np.cumsum(lengths)])
        word_ends = np.cumsum(counts)
        self.piece_ids.extend(flat, ends[word_ends] - ends[word_ends - counts])

    def encode(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(flat ids, number of ids per text)`` of whole texts."""
        if len(self.pieces) > PIECES:
            self._reset()
        number, numbers, counts = self.pieces.__getitem__, [], []
        for text in texts:
            keys = self._keys(text)
            numbers.append(np.fromiter(map(number, keys), np.int64, len(keys)))
            counts.append(len(keys))
        if self.pieces.fresh:
            self._learn()
        flat, lengths = self.piece_ids.rows(np.concatenate(numbers) if numbers else np.zeros(0, np.int64))
        ends = np.concatenate([[0], np.cumsum(lengths)])
        piece_ends, counts = np.cumsum(counts, dtype=np.int64), np.array(counts, np.int64)
        return flat, ends[piece_ends] - ends[piece_ends - counts]


def read_vocabulary(path: str) -> str:
    """The vocabulary file's JSON text, checked to be of the byte-level kind handled here."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    spec = json.loads(text)
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    plain = model.get("type") == "BPE" and not any(
        model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    by_bytes = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    if not (plain and by_bytes) or spec.get("normalizer"):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    for token in spec.get("added_tokens", []):
        if token.get("single_word") or token.get("lstrip") or token.get("rstrip") or token.get("normalized"):
            raise ValueError(f"special token {token['content']!r} has matching rules that are not handled")
    return text


def special_tokens(vocabulary: str) -> dict[str, int]:
    return {t["content"]: t["id"] for t in json.loads(vocabulary).get("added_tokens", [])}


def vocabulary_size(vocabulary: str) -> int:
    return max([*json.loads(vocabulary)["model"]["vocab"].values(), *special_tokens(vocabulary).values()]) + 1
