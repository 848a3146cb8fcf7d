"""Benchmark decontamination by edit distance between items and windows of documents.

Texts are sequences of words, lower-cased and stripped of punctuation; in scripts written without
blanks (Chinese, Japanese, Thai, Lao, Khmer, Burmese, Tibetan) every character is a word.  A document is contaminated
by an item when some window of it is within the item's edit budget: ``EDIT_SHARE`` of its words,
insertions, deletions and substitutions alike.

1. Items of more than ``SEGMENT`` words are cut into even segments of that length at most.  Of the edits
   of an item some segment has no more than its own share of words allows, so an item is found by any of its segments.
2. A window within the budget keeps a known number of the segment's word triples.  Starts of windows
   that hold fewer triples of any item are passed over; this loses nothing.
3. At the starts left, the window is embedded by a random walk that copies the word it stands on
   and steps on or stays by a random bit of that word and step, so that few edits differ in few
   places.  A key samples ``SAMPLED`` places; windows and segments that share a key under any of the
   repetitions are candidates.  The number of repetitions is the least that finds the share
   ``RECALL`` of simulated segments edited to the full budget, for the worst kind of edits.
4. Candidates are verified by the exact edit distance of the whole item, with a free end of the window.

Every item that may have an edit goes this way, whatever its length.  Items of fewer than ``MIN_WORDS`` words may have
none, as no triple would survive one: they are found where exactly their words stand in a row.

Items without words, empty and null items match nothing; repeated items count once per id.  Items are taken in blocks
of at most ``ITEM_BLOCK`` items and ``ITEM_BYTES`` bytes, which bounds what goes with a job; a worker makes a block ready once.
Null and empty documents match nothing; null and repeated ``doc_id`` and repeated rows are rows like any other, and an
empty table gives an empty one.  Other columns are ignored by ``matches`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.mph import mix
from chunkwright.llm.shared import keyed_texts, ragged, text_parts

EDIT_SHARE = 0.2
MIN_WORDS = 6
SEGMENT = 25
SAMPLED = 3
RECALL = 0.99
ITEM_BLOCK = 20_000
ITEM_BYTES = 16 << 20
# Bytes of text worked on at once; bounds a task's memory.
STEP_BYTES = 2 << 20
LEAST_REPETITIONS, MAX_REPETITIONS = 12, 160
REMEMBERED = 600_000
UNSPLIT = -2  # stands for a word that holds several
_MASK = (1 << 22) - 1
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_UNSPACED = re.compile(
    "([\u0e01-\u0e4e\u0e81-\u0edf\u0f40-\u0fbc\u1000-\u109f\u1780-\u17d3\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u3035"
    "\u3040-\u30fa\u30fc-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f"
    "\U0001b000-\U0001b16f\U00020000-\U0003ffff])"
)
_U = np.uint64


def normal(word: str) -> str:
    if word.isascii():
        return word.lower() if word.isalnum() else _EDGE.sub("", word.lower())
    # Vowel and tone signs are characters of their own, no edge to strip.
    return word if _UNSPACED.fullmatch(word) else _EDGE.sub("", word.lower())


def split_words(text: str) -> list[str]:
    """Words between blanks, and the single characters of scripts without blanks."""
    return _UNSPACED.sub(r" \1 ", text).split()


def words_of(text: str) -> list[str]:
    return [w for w in map(normal, split_words(text)) if w]


def budget(n: int) -> int:
    """Edits allowed for ``MIN_WORDS`` words and more; at least one triple must survive them."""
    return max(0, min(int(EDIT_SHARE * n), (n - 3) // 3))


def edit_distance(item: np.ndarray, window: np.ndarray, most: int) -> tuple[int, int]:
    """Least edits that turn ``item`` into a prefix of ``window``, and that prefix's length.

    Distances above ``most`` come back as ``most + 1``.
    """
    item, window = item.tolist(), window.tolist()
    width = len(window)
    row = list(range(width + 1))
    for i, word in enumerate(item, 1):
        lo, hi = max(1, i - most), min(width, i + most)
        fresh = [most + 1] * (width + 1)
        if i <= most:
            fresh[0] = i
        for j in range(lo, hi + 1):
            best = row[j - 1] + (word != window[j - 1])
            if row[j] + 1 < best:
                best = row[j] + 1
            if fresh[j - 1] + 1 < best:
                best = fresh[j - 1] + 1
            fresh[j] = best
        row = fresh
        if min(row) > most:
            return most + 1, 0
    end = min(range(width + 1), key=row.__getitem__)
    return min(row[end], most + 1), end


def least_edits(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Per start in ``text``, the least edits that turn ``item`` into words from there on.

    Both are read backwards, so that one table serves all starts.
    """
    backwards, at = text[::-1], np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item[::-1].tolist(), 1):
        fresh = row + 1
        fresh[1:] = np.minimum(fresh[1:], row[:-1] + (backwards != word))
        fresh[0] = i
        row = np.minimum.accumulate(fresh - at) + at
    return row[:0:-1]


def _codes(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    a, b, c = (x.astype(np.uint64) for x in (a, b, c))
    with np.errstate(over="ignore"):
        return mix(a * _U(0x9E3779B97F4A7C15) + b * _U(0xC2B2AE3D27D4EB4F) + c * _U(0x165667B19E3779F9))


def _triples(ids: np.ndarray) -> np.ndarray:
    return _codes(ids[:-2], ids[1:-1], ids[2:])


def _runs(ids: np.ndarray, n: int) -> np.ndarray:
    """One code per ``n`` words in a row."""
    codes = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for k in range(n):
        with np.errstate(over="ignore"):
            codes = mix(codes * _U(31) + ids[k : k + len(codes)].astype(np.uint64) + _U(1))
    return codes


def _slots(codes: np.ndarray) -> np.ndarray:
    return (codes & _U(_MASK)).astype(np.int64)


def _edited(length: int, kind: int | None, rng: np.random.Generator) -> list[int]:
    """Words ``1 .. length`` with all the edits allowed, of one kind or (``None``) of all three."""
    copy = list(range(1, length + 1))
    for _ in range(budget(length)):
        i = int(rng.integers(len(copy)))
        match rng.integers(3) if kind is None else kind:
            case 0:
                copy[i] = 0
            case 1:
                copy.insert(i, 0)
            case _:
                del copy[i]
    return copy


@lru_cache(maxsize=1024)
def repetitions(length: int, steps: int) -> int:
    """Repetitions that find ``RECALL`` of the segments of this length with all their edits.

    An item is found with chance ``1 - (1 - r) ** repetitions``, its own ``r`` being the mean over walks.
    """
    rng, trials, walks = np.random.default_rng(1), 64, 32
    kinds = [0, 1, 2, None]
    copies = np.full((len(kinds) * trials + 1, length + budget(length) + 1), length + 1)
    texts = [_edited(length, kind, rng) for kind in kinds for _ in range(trials)]
    for row, text in zip(copies, [*texts, range(1, length + 1)]):
        row[: len(text)] = text
    at = np.zeros((walks, len(copies)), np.int64)
    equal = np.zeros((walks, len(texts)))
    last, which, walk = copies.shape[1] - 1, np.arange(len(copies)), np.arange(walks)[:, None]
    for _ in range(steps):
        symbols = copies[which, np.minimum(at, last)]
        equal += symbols[:, :-1] == symbols[:, -1:]
        at += rng.integers(0, 2, (walks, length + 2))[walk, symbols]
    rates = ((equal / steps) ** SAMPLED).mean(0).reshape(len(kinds), trials)
    for number in range(LEAST_REPETITIONS, MAX_REPETITIONS + 1):
        if (1 - (1 - rates) ** number).mean(1).min() >= RECALL:
            return number
    raise ValueError(f"{length} words need more than {MAX_REPETITIONS} repetitions")


class Walks:
    """Bits and sampled places of the repetitions for windows of about ``length`` words."""

    def __init__(self, length: int, repetitions: int, words: int):
        rng = np.random.default_rng(length)
        self.places = np.sort(rng.integers(0, 2 * length, (repetitions, SAMPLED)), axis=1)
        self.steps = int(self.places.max()) + 1
        self.bits = rng.integers(0, 1 << 63, (repetitions, -(-self.steps // 63), words + 2), dtype=np.int64)

    def keys(self, texts: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One key per repetition and start; beyond its end a text reads as padding."""
        repetitions = len(self.places)
        pad = self.bits.shape[2] - 1
        at = np.broadcast_to(starts, (repetitions, len(starts))).copy()
        keys = np.zeros(at.shape, np.uint64)
        which = np.arange(repetitions)[:, None]
        for step in range(self.steps):
            inside = at < ends
            symbol = np.where(inside, texts[np.minimum(at, len(texts) - 1)], pad)
            for r, hits in enumerate((self.places == step).sum(1).tolist()):
                for _ in range(hits):
                    with np.errstate(over="ignore"):
                        keys[r] = mix(keys[r] * _U(31) + symbol[r].astype(np.uint64) + _U(1))
            at += (self.bits[which, step // 63, symbol] >> (step % 63)) & 1
        return keys


class Benchmark:
    """Items of one block, ready to be searched for."""

    def __init__(self, items: list[tuple[object, str]]):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[object, np.ndarray]] = []
        for item_id, text in items:
            words = words_of(text or "")
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
                self.items.append((item_id, np.array(ids, np.int32)))
        self.known = np.zeros(_MASK + 1, bool)
        self._own: dict[int, np.ndarray] = {}
        # Items too short for edits by their length, in the order of their codes.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({len(ids) for _, ids in self.items if len(ids) < MIN_WORDS}):
            members = np.array([i for i, (_, ids) in enumerate(self.items) if len(ids) == n])
            codes = np.concatenate([_runs(self.items[i][1], n) for i in members])
            order = np.argsort(codes, kind="stable")
            self.short[n] = codes[order], members[order]
        # Segments: their item, where they begin in it, and their words.
        self.segments: list[tuple[int, int, np.ndarray]] = []
        for i, (_, ids) in enumerate(self.items):
            if len(ids) >= MIN_WORDS:
                self.known[_slots(_triples(ids))] = True
                cuts = np.linspace(0, len(ids), -(-len(ids) // SEGMENT) + 1).astype(int).tolist()
                self.segments += [(i, low, ids[low:high]) for low, high in zip(cuts, cuts[1:])]
        # Items of like length, and of them segments of like length, share windows: the longest is at most a fifth longer.
        long = [i for i, (_, ids) in enumerate(self.items) if len(ids) >= MIN_WORDS]
        self.classes = []
        for items in _alike(long, lambda i: len(self.items[i][1])):
            held = set(items)
            segments = [n for n, (i, *_) in enumerate(self.segments) if i in held]
            lengths = [len(self.items[i][1]) for i in items]
            searches = [self._search(members) for members in _alike(segments, lambda n: len(self.segments[n][2]))]
            self.classes.append((*_windows_of(lengths), ItemTriples([self.items[i][1] for i in items]), searches))

    def own(self, item: int) -> np.ndarray:
        """The item's triples in order."""
        if item not in self._own:
            self._own[item] = np.unique(_triples(self.items[item][1]))
        return self._own[item]

    def _search(self, members: list[int]):
        lengths = [len(self.segments[n][2]) for n in members]
        shortest = lengths[0]
        # Walks over all of a class are as long as its shortest segment asks; its densest edits count.
        number = repetitions(max(lengths, key=lambda n: budget(n) / n), 2 * shortest)
        walks = Walks(shortest, number, len(self.vocabulary))
        texts = np.concatenate([self.segments[n][2] for n in members])
        ends = np.cumsum(lengths)
        keys = walks.keys(texts, ends - lengths, ends)
        tables = []
        for row in keys:
            order = np.argsort(row, kind="stable")
            tables.append((row[order], np.array(members)[order]))
        return *_windows_of(lengths), walks, tables


def _alike(members: list[int], size) -> list[list[int]]:
    classes: list[list[int]] = []
    for n in sorted(members, key=size):
        if not classes or size(n) > 1.2 * size(classes[-1][0]):
            classes.append([])
        classes[-1].append(n)
    return classes


def _windows_of(lengths: list[int]) -> tuple[int, int]:
    """Within how many starts a window keeps its triples, and how many at least it keeps."""
    return max(n + budget(n) for n in lengths) - 2, min(n - 2 - 3 * budget(n) for n in lengths)


class ItemTriples:
    """Which items hold which triples, to tell where enough triples of one item stand close together."""

    def __init__(self, items: list[np.ndarray]):
        self.lengths = np.array([len(ids) for ids in items])
        self.most = np.array([budget(n) for n in self.lengths])
        self.own = [np.unique(_triples(ids)) for ids in items]
        codes, members = np.concatenate(self.own), np.repeat(np.arange(len(items)), [len(o) for o in self.own])
        order = np.argsort(codes, kind="stable")
        self.codes, self.members = codes[order], members[order]
        self.need = self.lengths - 2 - 3 * self.most

    def ranges(self, places: np.ndarray, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ranges of words of a text, with these triples, that windows within the budget of an item may lie in."""
        distinct, times = np.unique(codes, return_counts=True)
        left = np.searchsorted(self.codes, distinct, "left")
        holders = np.searchsorted(self.codes, distinct, "right") - left
        shared = np.bincount(self.members[ragged(left, holders)], np.repeat(times, holders), len(self.own))
        for member in np.flatnonzero(shared >= self.need).tolist():
            own, need, width = self.own[member], int(self.need[member]), int(self.lengths[member] + self.most[member])
            found = places[own[np.minimum(np.searchsorted(own, codes), len(own) - 1)] == codes]
            firsts, lasts = found[: len(found) - need + 1], found[need - 1 :]
            close = lasts - firsts < width - 2
            # A start may precede its first triple by the triples that edits spoil.
            yield np.maximum(0, lasts[close] - width + 3), firsts[close] + width


def _best_window(item: np.ndarray, text: np.ndarray, starts: list[tuple[int, int]]) -> tuple[int, int]:
    """Least edits, and the first word, of the windows of a text that begin within some ranges, ends included."""
    most, merged = budget(len(item)), []
    for low, high in sorted(starts):
        if merged and low <= merged[-1][1] + len(item) // 4:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    found = (most + 1, 0)
    for low, high in merged:
        edits = least_edits(item, text[low : high + len(item) + most])[: high - low + 1]
        if len(edits):
            found = min(found, (int(edits.min()), low + int(edits.argmin())))
    return found


class Finder:
    """Searches whole documents, a batch at a time."""

    def __init__(self, benchmark: Benchmark):
        self.benchmark = benchmark
        vocabulary = benchmark.vocabulary

        class Ids(dict):
            def __missing__(self, word: str) -> int:
                if len(word) > 1 and not word.isascii() and _UNSPACED.search(word):
                    return UNSPLIT
                plain = normal(word)
                number = self[word] = vocabulary.get(plain, 0) if plain else -1
                return number

        self.ids = Ids()

    def __call__(self, texts: list[str]) -> Iterator[tuple[int, object, int, int, int]]:
        """``(row, item id, first word, end word, edits)``: the best window per document and item."""
        if not self.benchmark.items:
            return
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
        rows = []
        for text in texts:
            words = text.split()
            ids = np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))
            if (ids == UNSPLIT).any():
                words = split_words(text)
                ids = np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))
            rows.append(ids[ids >= 0])
        lengths = np.array([len(r) for r in rows], np.int64)
        flat = np.concatenate([*rows, np.zeros(4, np.int32)])
        ends = np.cumsum(lengths)
        owner_end = np.repeat(ends, lengths)
        owner = np.repeat(np.arange(len(rows)), lengths)
        known = (flat[:-2] > 0) & (flat[1:-1] > 0) & (flat[2:] > 0)
        places = np.flatnonzero(known)
        codes = _codes(flat[places], flat[places + 1], flat[places + 2])
        hit = self.benchmark.known[_slots(codes)] & (places + 2 < owner_end[places])
        places, codes = places[hit], codes[hit]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for n, (table, members) in self.benchmark.short.items():
            runs = _runs(flat[: len(owner)], n)
            left = np.searchsorted(table, runs, "left")
            found = np.flatnonzero((table[np.minimum(left, len(table) - 1)] == runs) & (np.arange(len(runs)) + n <= owner_end[: len(runs)]))
            # The first place of each in every document.
            _, first = np.unique(owner[found] * len(table) + left[found], return_index=True)
            for at in found[first].tolist():
                row = int(owner[at])
                start = at - int(ends[row] - lengths[row])
                for item in members[left[at] : np.searchsorted(table, runs[at], "right")].tolist():
                    best[(row, item)] = (0, start, start + n)
        wanted: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)

        def starts_of(span: int, need: int) -> np.ndarray:
            """Places that may begin a window which keeps ``need`` known triples, as flags."""
            # `need` known triples in a row of starts end within `span` of the first.
            covered = np.zeros(len(flat) + 1, np.int32)
            if len(places) >= need:
                close = places[need - 1 :] - places[: len(places) - need + 1] < span
                firsts, lasts = places[: len(places) - need + 1][close], places[need - 1 :][close]
                same = owner[firsts] == owner[lasts]
                firsts, lasts = firsts[same], lasts[same]
                # A start may precede its first known triple by the triples that edits spoil.
                begin_of = ends[owner[firsts]] - lengths[owner[firsts]]
                np.add.at(covered, np.maximum(begin_of, lasts - span + 1), 1)
                np.add.at(covered, firsts + 1, -1)
            return np.cumsum(covered[:-1]) > 0

        searches = []
        for item_span, item_need, triples, inner in self.benchmark.classes:
            # Segments are looked for only where one whole item can be.
            near = np.zeros(len(flat) + 1, np.int32)
            for row in np.unique(owner[np.flatnonzero(starts_of(item_span, item_need))]).tolist():
                begin, end = int(ends[row] - lengths[row]), int(ends[row])
                a, b = np.searchsorted(places, [begin, end]).tolist()
                for low, high in triples.ranges(places[a:b] - begin, codes[a:b]):
                    np.add.at(near, begin + low, 1)
                    np.add.at(near, np.minimum(begin + high, end), -1)
            inside = np.cumsum(near[:-1]) > 0
            if inside.any():
                searches += [(np.flatnonzero(inside & starts_of(span, need)), walks, tables) for span, need, walks, tables in inner]
        for starts, walks, tables in searches:
            candidates: set[tuple[int, int]] = set()
            for i in range(0, len(starts), 4096):
                part = starts[i : i + 4096]
                keys = walks.keys(flat, part, owner_end[part])
                for row, (table, members) in zip(keys, tables):
                    left, right = np.searchsorted(table, row, "left"), np.searchsorted(table, row, "right")
                    for at in np.flatnonzero(right > left).tolist():
                        for item in members[left[at] : right[at]].tolist():
                            candidates.add((int(part[at]), item))
            for start, n in candidates:
                item, offset, _ = self.benchmark.segments[n]
                row = int(owner[start])
                begin, most = start - int(ends[row] - lengths[row]) - offset, budget(len(self.benchmark.items[item][1]))
                # Edits before the segment shift where the item begins.
                slack = most if offset else 0
                wanted[row, item].append((max(0, begin - slack), max(0, begin + slack)))
        for (row, item), starts in wanted.items():
            ids, base = self.benchmark.items[item][1], int(ends[row] - lengths[row])
            # Windows with too few triples of this very item are beyond its budget.
            own, most, kept = self.benchmark.own(item), budget(len(ids)), []
            for low, high in starts:
                a, b = np.searchsorted(places, (base + low, base + high + len(ids) + most))
                held = codes[a:b]
                if (own[np.minimum(np.searchsorted(own, held), len(own) - 1)] == held).sum() >= len(ids) - 2 - 3 * most:
                    kept.append((low, high))
            if not kept:
                continue
            text = flat[base : ends[row]]
            edits, first = _best_window(ids, text, kept)
            if edits <= budget(len(ids)):
                best[(row, item)] = (edits, first, first + edit_distance(ids, text[first : first + len(ids) + budget(len(ids))], edits)[1])
        for (row, item), (edits, first, end) in sorted(best.items()):
            yield row, self.benchmark.items[item][0], first, end, edits


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, some ``ITEM_BLOCK`` or ``ITEM_BYTES`` at a time: the only rows that come to the driver."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("bigint"), "text").distinct()
    size = items.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size.rows // ITEM_BLOCK), -(-size.bytes // ITEM_BYTES))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield [(r[0], r[1]) for r in part.orderBy("item_id", "text").collect()]


_built: dict[str, Finder] = {}


def _finder(shared: Broadcast, name: str) -> Finder:
    """The finder of a block, made once per worker."""
    if name not in _built:
        _built.clear()
        _built[name] = Finder(Benchmark(shared.value))
    return _built[name]


FOUND = "doc_id bigint, item_id bigint, first_word int, end_word int, edits int"


def matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, first_word, end_word, edits`` of every contaminated document and item."""
    result = None
    for items in item_blocks(benchmark):

        shared, name = documents.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            for batch in (part for whole in batches for part in text_parts(whole, "text", STEP_BYTES)):
                finder = _finder(shared, name)
                found = list(finder(batch.column("text").to_pylist()))
                ids = batch.column("doc_id").to_pylist()
                columns = [[ids[f[0]] for f in found], *([f[i] for f in found] for i in range(1, 5))]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "first_word", "end_word", "edits"]
                )

        part = keyed_texts(documents).mapInArrow(run, FOUND)
        result = part if result is None else result.unionByName(part)
    return result


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, that no item contaminates."""
    kept = documents
    for items in item_blocks(benchmark):

        shared, name = documents.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            for batch in (part for whole in batches for part in text_parts(whole, "text", STEP_BYTES)):
                finder = _finder(shared, name)
                clean = np.ones(batch.num_rows, bool)
                clean[[f[0] for f in finder([t or "" for t in batch.column("text").to_pylist()])]] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(run, documents.schema)
    return kept
