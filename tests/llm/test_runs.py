"""Periodic runs against a version that tries every period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from chunkwright.llm import runs
from chunkwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """``(start, period, length)`` of all runs, by comparing the words with themselves shifted by every period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    return sorted((s, q, length) for (s, length), q in found.items())


def plain_row(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(key).encode() if key is not None else b"")
    g = h // 10
    if h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    best = max(found, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]), default=None)
    gone = {i for s, q, length in found for i in range(s + q, s + length)}
    hexed = lambda text: hashlib.sha256(text.encode()).hexdigest()
    told = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, q, length in found)
    return key, len(found), *told, hexed(listed), hexed(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_query_equals_the_plain_version(spark):
    got = {tuple(r) for r in QUERIES["op11_grammar_runs"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == {plain_row(*r) for r in rows}
    assert sum(r[1] for r in got) > 20


def _texts(rng):
    for _ in range(400):
        letters, n = rng.choice([1, 2, 2, 3, 5, 30]), rng.randint(0, 120)
        kind = rng.random()
        if kind < 0.3:
            yield [rng.randrange(letters) for _ in range(n)]
        elif kind < 0.7:
            row = []
            while len(row) < n:
                unit = [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
                row += (unit * rng.randint(1, 9))[: rng.randint(1, 60)]
            yield row
        elif kind < 0.9:
            unit = [0]
            for _ in range(3):
                unit = unit * rng.randint(1, 6) + [rng.randrange(letters + 1)]
            yield (unit * rng.randint(1, 8))[:400]
        else:
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            yield b


def test_runs_of_nested_periods():
    rows = list(_texts(random.Random(5)))
    found = runs.find_runs(np.array([w for r in rows for w in r], np.int64), np.array([len(r) for r in rows]))
    got = [[] for _ in rows]
    for text, start, length, period in zip(*[x.tolist() for x in found]):
        got[text].append((start, period, length))
    assert [sorted(g) for g in got] == [plain_runs(r) for r in rows]


def test_long_texts_of_one_period():
    for unit, times in (([0], 200_000), (list(range(700)), 90), ([0] * 300 + [1], 200)):
        found = runs.find_runs(np.array(unit * times), np.array([len(unit) * times]))
        whole = (0, 0, len(unit) * times, len(unit))
        assert whole in set(zip(*[x.tolist() for x in found]))


def test_grammar_derives_its_text():
    rng = np.random.default_rng(3)
    words, lengths = rng.integers(0, 3, 5000), np.array([0, 2000, 1, 2999])
    group = np.repeat(np.arange(4), lengths)
    words = np.unique(group * 10 + words, return_inverse=True)[1].astype(np.int64)
    grammar = runs.re_pair(words, group)

    def derive(symbol):
        if symbol < grammar.base:
            return [symbol]
        at = symbol - grammar.base
        return derive(int(grammar.left[at])) + derive(int(grammar.right[at]))

    assert [w for s in grammar.symbols.tolist() for w in derive(s)] == words.tolist()
    left = list(zip(grammar.group.tolist()[:-1], grammar.symbols.tolist(), grammar.symbols.tolist()[1:], grammar.group.tolist()[1:]))
    pairs = [(a, b) for g, a, b, h in left if g == h and a != b]
    assert len(pairs) == len(set(pairs)), "a pair is left that occurs twice"


def test_odd_rows(spark, oddities, nothing):
    wanted = sorted((plain_row(r.doc_id, r.text) for r in oddities.where("text IS NULL OR length(text) < 10000").collect()), key=repr)
    got = [tuple(r) for r in runs.run_digests(oddities).collect()]
    assert sorted((r for r in got if r[3] != 60_000), key=repr) == wanted
    assert [r[:6] for r in got if r[3] == 60_000] == [(10, 1, 0, 60_000, 1, 60_000_000)]
    found = runs.periodic_runs(oddities)
    assert set(found.columns) == set(oddities.columns) and found.count() == oddities.count()
    assert found.where("doc_id = 7").first().collapsed == "one two"
    assert runs.run_digests(nothing).count() == 0
