"""Periodic runs of words, found on a grammar of the text.

A run is a stretch of consecutive words with smallest period ``q`` that repeats at least
``REPEATS`` times and has at least ``LEAST`` words, and that no neighbouring word extends.

Every text is its own problem, so documents are only scanned, in batches of bounded bytes:

1. Every pair of neighbouring words of a run occurs three times or more within it.  Stretches of
   words whose pairs occur less often hold no run and are left out (``live_stretches``).
2. Re-Pair compresses the stretches left: of overlapping pairs the more frequent one is replaced,
   in rounds, until no pair occurs twice (``re_pair``).
3. A run lies across the boundary of the lowest node of the derivation that holds it whole.  So
   the runs across the boundary of each nonterminal are computed once, on one place where it
   stands, and those across the boundaries of the sequence left (``crossing_runs``).
4. They are translated to all places where their nonterminals stand (``translate``); pieces of
   one run, which overlap by a period or more, merge into the maximal interval (``merge``).

Runs across a boundary have two periods or more on one side of it.  ``_squares`` finds the periods
from the names of all stretches of 2^k words: equal words have equal names, so a square, and how
far a period reaches, are a few comparisons of names, exact at any length.

Null and empty texts have no words and no runs.  Null ``doc_id``, repeated ids and repeated rows
are rows like any other; an empty table gives an empty table.  Very long texts are one batch each:
names take 4 bytes per word and level (log2 of the words), for the live stretches only.  Of two
runs with equal exponents the one that starts first, then the one of smaller period, is the
greatest.  All columns are kept; ``runs`` and ``collapsed``, where there are any, are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright.llm.shared import ragged, text_parts

REPEATS = 4
LEAST = 6
# Bytes of text worked on at a time, one longer text excepted.
STEP_BYTES = 2 << 20
# Rounds of the pair filter; it only leaves out what holds no run, so fewer rounds lose nothing.
FILTER_ROUNDS = 6
RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))
Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * _MIX
    x ^= x >> np.uint64(29)
    x *= _MIX
    return x ^ (x >> np.uint64(32))


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last index of every run of true flags."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def live_stretches(ids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of the stretches that may hold runs.

    ``group`` numbers the text of each word.  Pairs are counted by a hash within their stretch, which
    never counts too few.
    """
    place = np.arange(len(ids))
    starts = lengths = np.zeros(0, np.int64)
    for _ in range(FILTER_ROUNDS):
        if len(place) < LEAST:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = _mix(_mix(ids[:-1] + 1) + ids[1:].astype(np.uint64) + (group[:-1].astype(np.uint64) << np.uint64(32)))
        bits = max(8, int(len(ids)).bit_length() + 2)
        slot = (pair >> np.uint64(64 - bits)).astype(np.int64)
        same = group[:-1] == group[1:]
        live = same & (np.bincount(slot[same], minlength=1 << bits)[slot] >= REPEATS - 1)
        first, end = _spans(live)
        long = end - first >= LEAST - 1
        first, counts = first[long], end[long] - first[long] + 1
        taken = ragged(first, counts)
        starts, lengths = place[first], counts
        settled = len(taken) == len(place)
        place, ids, group = place[taken], ids[taken], np.repeat(np.arange(len(counts)), counts)
        if settled:
            break
    return starts, lengths


class Grammar:
    """Rules ``left, right`` of the nonterminals from ``base`` on, and the sequences left.

    ``size`` is the number of words of every symbol, ``first`` one place where a rule stands, ``rounds``
    the end of every round's rules.  ``symbols`` at ``places`` are the sequences left, by ``group``.
    """

    def __init__(self, words: np.ndarray, group: np.ndarray):
        self.base = int(words.max()) + 1 if len(words) else 0
        self.size = np.ones(self.base, np.int64)
        self.left = self.right = self.first = np.zeros(0, np.int64)
        self.rounds: list[int] = []
        self.symbols, self.places, self.group = words, np.arange(len(words)), group


def re_pair(words: np.ndarray, group: np.ndarray) -> Grammar:
    """The grammar of the sequences ``words``; sequences of different ``group`` share no word."""
    grammar = Grammar(words, group)
    symbols, places, group = grammar.symbols, grammar.places, group
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    worst = np.iinfo(np.int64).max
    while len(symbols) > 1:
        n, total = len(symbols) - 1, len(grammar.size)
        # Of a block of one symbol every second pair counts, from the first on.
        equal = symbols[:-1] == symbols[1:]
        at = np.arange(n)
        begin = np.maximum.accumulate(np.where(equal & ~np.concatenate([[False], equal[:-1]]), at, 0))
        usable = (group[:-1] == group[1:]) & ~(equal & ((at - begin) % 2 == 1))
        where = np.flatnonzero(usable)
        keys, kind, counts = np.unique(symbols[where] * total + symbols[where + 1], return_inverse=True, return_counts=True)
        often = counts >= 2
        order = np.lexsort((_mix(keys), -counts))
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys))
        rank[~often] = worst
        ranks = np.full(n + 2, worst)
        ranks[where + 1] = rank[kind]
        best = (ranks[1:-1] < ranks[:-2]) & (ranks[1:-1] < ranks[2:])
        chosen = best[where]
        kept = np.bincount(kind[chosen], minlength=len(keys)) >= 2
        chosen &= kept[kind]
        at, kind = where[chosen], kind[chosen]
        # Sequences without a pair to replace are at their end.
        active = np.zeros(int(group[-1]) + 1, bool)
        active[group[at]] = True
        over = ~active[group]
        if over.any():
            done.append((symbols[over], places[over], group[over]))
        if len(at):
            number = np.cumsum(kept) - 1 + total
            new, one = np.unique(kind, return_index=True)
            left, right = keys[new] // total, keys[new] % total
            grammar.left = np.concatenate([grammar.left, left])
            grammar.right = np.concatenate([grammar.right, right])
            grammar.first = np.concatenate([grammar.first, places[at[one]]])
            grammar.size = np.concatenate([grammar.size, grammar.size[left] + grammar.size[right]])
            grammar.rounds.append(len(grammar.size))
            symbols = symbols.copy()
            symbols[at] = number[kind]
            over[at + 1] = True
        symbols, places, group = symbols[~over], places[~over], group[~over]
    done.append((symbols, places, group))
    grammar.symbols, grammar.places, grammar.group = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(grammar.places, kind="stable")
    grammar.symbols, grammar.places, grammar.group = grammar.symbols[order], grammar.places[order], grammar.group[order]
    return grammar


class Names:
    """Per level ``k`` the names of all stretches of 2^k words: equal where the words are, -1 where none fits."""

    def __init__(self, words: np.ndarray, ends: np.ndarray, lengths: np.ndarray):
        self.levels = [words.astype(np.int32)]
        self.ends, self.lengths = ends, lengths

    def extend(self) -> None:
        """Name the stretches of the next level, where texts are long enough for a run of that period."""
        k, last = len(self.levels), self.levels[-1]
        half = 1 << (k - 1)
        at = np.flatnonzero((self.lengths >= REPEATS << k) & (np.arange(len(last)) + (1 << k) <= self.ends))
        names = np.full(len(last), -1, np.int32)
        if len(at):
            keys = last[at].astype(np.int64) * (int(last.max()) + 1) + last[at + half]
            names[at] = np.unique(keys, return_inverse=True)[1]
        self.levels.append(names)

    def reach(self, i: np.ndarray, j: np.ndarray, step: int, limit: np.ndarray) -> np.ndarray:
        """Equal words from ``i`` and ``j`` on (``step`` 1), or before them (-1), ``limit`` at most or a little more."""
        i, j = i.copy(), j.copy()
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names, width = self.levels[k], 1 << k
            active = np.arange(len(i))
            while len(active):
                active = active[got[active] < limit[active]]
                a, b = (i[active], j[active]) if step > 0 else (i[active] - width, j[active] - width)
                fits = (a >= 0) & (np.maximum(a, b) < len(names))
                active, a, b = active[fits], a[fits], b[fits]
                same = (names[a] == names[b]) & (names[a] >= 0)
                active = active[same]
                i[active] += step * width
                j[active] += step * width
                got[active] += width
        return np.minimum(got, limit)


def _neighbours(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the next and of the previous equal name; far beyond either end where there is none."""
    far = 4 * len(names) + 4
    following, previous = np.full(len(names), far), np.full(len(names), -far)
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    same = names[at[1:]] == names[at[:-1]]
    following[at[:-1][same]], previous[at[1:][same]] = at[1:][same], at[:-1][same]
    return following, previous


def _squares(names: Names, begin: np.ndarray, cut: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Boundaries with a square that starts or ends there: their number, the square's start, its period.

    Periods from 2^k to below 2^(k+1) follow from level ``k``: the 2^k words after (before) the boundary must
    stand a period further on (back), and so must the last (first) 2^k words of that period.  Where a period
    ``d`` found before covers those words, places inside its reach give multiples of ``d`` only and are skipped.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    known = {1: np.zeros(len(cut), np.int64), -1: np.zeros(len(cut), np.int64)}
    k = 0
    while len(cut) and (REPEATS << k) <= int((end - begin).max()):
        if k:
            names.extend()
        level, width = names.levels[k], 1 << k
        links = dict(zip((1, -1), _neighbours(level)))
        for side in (1, -1):
            room = (end - cut) if side > 0 else (cut - begin)
            at = np.flatnonzero((end - begin >= REPEATS << k) & (room >= 2 * width))
            start = cut[at] if side > 0 else cut[at] - width
            period = known[side][at]
            jump = np.zeros(len(at), np.int64)
            fit = np.flatnonzero((period > 0) & (2 * period <= width))
            if len(fit):
                d, c = period[fit], cut[at[fit]]
                enough = np.minimum(room[at[fit]] - d, 2 * width)
                reach = d + (names.reach(c, c + d, 1, enough) if side > 0 else names.reach(c - d, c, -1, enough))
                covered = reach >= width
                jump[fit[covered]] = ((reach - width) // d * d)[covered]
                # Beyond the reach only periods above ``reach - d`` are left.
                jump[fit[covered & (reach - d >= 2 * width)]] = -1
            at, start, jump = at[jump >= 0], start[jump >= 0], jump[jump >= 0]
            place = links[side][start + side * jump]
            while len(at):
                period = side * (place - start)
                fits = (period < 2 * width) & (2 * period <= room[at])
                at, start, place, period = at[fits], start[fits], place[fits], period[fits]
                wide = period >= width
                a, q, c = at[wide], period[wide], cut[at[wide]]
                one, two = (c + q - width, c + 2 * q - width) if side > 0 else (c - q, c - 2 * q)
                square = level[one] == level[two]
                a, q, c = a[square], q[square], c[square]
                found.append((a, c if side > 0 else c - q, q))
                known[side][a] = q
                place = links[side][place]
        k += 1
    return tuple(np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), (), ())))


def crossing_runs(names: Names, begin: np.ndarray, cut: np.ndarray, end: np.ndarray) -> Runs:
    """Runs of ``[begin, end)`` across ``cut``, ends of the interval included: boundary, start, length, period."""
    which, start, period = _squares(names, begin, cut, end)
    low, high, at = begin[which], end[which], cut[which]
    first = start - names.reach(start, start + period, -1, start - low)
    last = start + period + names.reach(start, start + period, 1, high - start - period)
    runs = np.unique(np.stack([which, first, last - first, period], axis=1), axis=0)
    which, first, length, period = runs.T
    good = (length >= np.maximum(LEAST, REPEATS * period)) & (first < cut[which]) & (first + length > cut[which])
    return which[good], first[good], length[good], period[good]


def translate(grammar: Grammar, rule: np.ndarray, offset: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of rules, by their offset in the rule, at all places where the rules stand: start, length, period."""
    order = np.argsort(rule, kind="stable")
    rule, offset, length, period = rule[order], offset[order], length[order], period[order]
    total, bounds = len(grammar.size), [grammar.base, *grammar.rounds]
    counts = np.bincount(rule, minlength=total) if len(rule) else np.zeros(total, np.int64)
    firsts = np.cumsum(counts) - counts
    holds = counts > 0
    for low, high in zip(bounds, bounds[1:]):
        r = np.arange(low, high)
        holds[r] |= holds[grammar.left[r - grammar.base]] | holds[grammar.right[r - grammar.base]]
    symbols, places = grammar.symbols[holds[grammar.symbols]], grammar.places[holds[grammar.symbols]]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for low in bounds[-2::-1]:
        now = symbols >= low
        s, p = symbols[now], places[now]
        at = ragged(firsts[s], counts[s])
        found.append((np.repeat(p, counts[s]) + offset[at], length[at], period[at]))
        left, right = grammar.left[s - grammar.base], grammar.right[s - grammar.base]
        below, where = np.concatenate([left, right]), np.concatenate([p, p + grammar.size[left]])
        symbols = np.concatenate([symbols[~now], below[holds[below]]])
        places = np.concatenate([places[~now], where[holds[below]]])
    return tuple(np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), (), ())))


def merge(group: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> Runs:
    """Maximal runs by group, start and period: pieces of one run merge, multiples of a period go."""
    if not len(start):
        return group, start, length, period
    order = np.lexsort((start, period, group))
    group, start, end, period = group[order], start[order], (start + length)[order], period[order]
    fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (period[1:] != period[:-1])])
    lane = (np.cumsum(fresh) - 1) * (int(end.max()) + 1)
    highest = np.maximum.accumulate(end + lane) - lane
    new = fresh.copy()
    new[1:] |= start[1:] > highest[:-1] - period[1:]
    first = np.flatnonzero(new)
    group, start, period, end = group[first], start[first], period[first], np.maximum.reduceat(end, first)
    order = np.lexsort((period, end, start, group))
    group, start, end, period = group[order], start[order], end[order], period[order]
    # The same words with a multiple of their period.
    again = (group[1:] == group[:-1]) & (start[1:] == start[:-1]) & (end[1:] == end[:-1])
    kept = np.concatenate([[True], ~again])
    group, start, length, period = group[kept], start[kept], (end - start)[kept], period[kept]
    order = np.lexsort((period, start, group))
    return group[order], start[order], length[order], period[order]


def find_runs(ids: np.ndarray, lengths: np.ndarray) -> Runs:
    """All runs of texts of word ids, end to end: number of the text, start in it, length, period."""
    texts = np.repeat(np.arange(len(lengths)), lengths)
    base = np.cumsum(lengths) - lengths
    starts, counts = live_stretches(ids, texts)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    taken = ragged(starts, counts)
    group = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    words = np.unique(group * (int(ids.max()) + 1) + ids[taken], return_inverse=True)[1].astype(np.int64)
    grammar = re_pair(words, group)
    rules = np.arange(grammar.base, len(grammar.size))
    middle = grammar.first + grammar.size[grammar.left]
    inner = np.flatnonzero(grammar.group[1:] == grammar.group[:-1]) + 1
    stretch = grammar.group[inner]
    begin = np.concatenate([grammar.first, (ends - counts)[stretch]])
    cut = np.concatenate([middle, grammar.places[inner]])
    end = np.concatenate([grammar.first + grammar.size[rules], ends[stretch]])
    large = np.flatnonzero(end - begin >= LEAST)
    names = Names(words, np.repeat(ends, counts), np.repeat(counts, counts))
    which, first, length, period = crossing_runs(names, begin[large], cut[large], end[large])
    which = large[which]
    of_rule = which < len(rules)
    r = which[of_rule]
    spread = translate(grammar, r + grammar.base, first[of_rule] - grammar.first[r], length[of_rule], period[of_rule])
    start, length, period = (np.concatenate([a, b[~of_rule]]) for a, b in zip(spread, (first, length, period)))
    where = taken[start]
    text = texts[where]
    return merge(text, where - base[text], length, period)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, joined by blanks, but those that a run holds after its first period."""
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()])


def periodic_runs(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add ``runs``, all runs of the words of ``text`` by start and period, and ``collapsed``, the words but the repeats.

    Words are what stands between ASCII white space; ``start`` is a word number from 0.
    """
    schema = T.StructType([f for f in documents.schema if f.name not in ("runs", "collapsed")])
    kept = list(schema.names)
    schema = schema.add("runs", RUNS).add("collapsed", T.StringType())

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        numbers = _Numbers()
        words = [(raw or b"").split() for raw in part.column(text).cast(pa.binary()).to_pylist()]
        lengths = np.array([len(w) for w in words], np.int64)
        ids = np.fromiter((numbers[w] for row in words for w in row), np.int64, int(lengths.sum()))
        which, *runs = find_runs(ids, lengths)
        runs = np.stack(runs, axis=1)
        offsets = np.searchsorted(which, np.arange(len(words) + 1))
        collapsed = [
            _collapse(row, runs[a:b]) if b > a else b" ".join(row) for row, a, b in zip(words, offsets.tolist(), offsets[1:].tolist())
        ]
        fields = [pa.array(runs[:, i], pa.int64()) for i in range(3)]
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
        columns = [*(part.column(c) for c in kept), lists, pa.array(collapsed, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, text, STEP_BYTES):
                yield step(part)

    return documents.mapInArrow(run, schema)


def planted(documents: DataFrame) -> DataFrame:
    """``doc_id, text`` with every tenth text, by the CRC-32 of its key, made periodic from some word on.

    A null key counts as empty text.  Words of the texts that change are joined by single blanks.
    """
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x <> '')")
    hashed = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("h")
    )
    chosen = hashed.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    g, n = "(h div 10)", "size(words)"
    a = f"({g} % {n})"
    p = f"(1 + ({n} - {a}) div (3 + {g} % 8))"
    rewritten = f"array_join(transform(words, (w, i) -> if(i < {a}, w, words[int({a} + (i - {a}) % {p})])), ' ')"
    return chosen.select("doc_id", F.when(F.expr(f"{n} > 0"), F.expr(rewritten)).otherwise(F.col("text")).alias("text"))


def run_digests(documents: DataFrame) -> DataFrame:
    """Runs of the planted texts as numbers and digests, one row per document."""
    best = (
        "aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (best, r) -> "
        "if(best is null or r.length * best.period > best.length * r.period, r, best))"
    )
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    found = periodic_runs(planted(documents))
    told = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.expr(best).alias("best"), F.expr(listed).alias("listed"), "collapsed")
    return told.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
