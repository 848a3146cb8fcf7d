"""Repeated passages against a version that looks up every window."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from chunkwright.llm import repeats
from chunkwright.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain(rows, window=20):
    """``doc_id, n_words, n_removed, kept`` of rows of key and text; of equal rows the first one given stands first."""
    rows = [(i, t, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0, n))
    seen, told = set(), {}
    for n in order:
        words, gone = rows[n][2], set()
        for at in range(len(words) - window + 1):
            passage = tuple(words[at : at + window])
            if passage in seen:
                gone |= set(range(at, at + window))
            seen.add(passage)
        told[n] = (rows[n][0], len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return [told[n] for n in range(len(rows))]


def digest(row):
    return (*row[:3], hashlib.sha256(row[3].encode()).hexdigest())


def test_query_equals_its_sql_and_the_plain_version(spark):
    got = sorted(tuple(r) for r in QUERIES["op12_winnowed_repeats"](spark, SF).collect())
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(db.execute(ORACLES["op12_winnowed_repeats"]).fetchall())
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert got == sorted(map(digest, plain(rows)))
    assert sum(r[2] for r in got) > 1000


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_of_all_lengths_and_near_copies(spark, seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passages = [[word() for _ in range(n)] for n in (19, 20, 21, 27, 28, 35, 60, 200)]
    rows = []
    for i in range(300):
        text = []
        for _ in range(rng.randint(0, 5)):
            text += [word() for _ in range(rng.randint(0, 30))]
            passage = list(rng.choice(passages))
            for _ in range(rng.choice([0, 0, 0, 1, 3])):
                passage[rng.randrange(len(passage))] = word()
            low = rng.choice([0, 0, rng.randrange(len(passage))])
            text += passage[low : low + rng.choice([500, 500, 22, 40])]
        rows.append((i, " ".join(text) + rng.choice(["", "\n", " a b"])))
    rows += [(400, "of the " * 300), (401, "x of the " * 50), (402, "of the " * 299 + "end")]
    got = repeats.passage_digests(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7))
    assert sorted(tuple(r) for r in got.collect()) == sorted(map(digest, plain(rows)))


def test_long_texts_are_cut_anywhere(monkeypatch):
    rng = np.random.default_rng(4)
    words = rng.integers(0, 2**63, 500).astype(np.uint64)
    text, ends = np.zeros(500, np.int64), np.full(500, 500)
    first, n, anchor, span = repeats._spans(words, text, ends, 20, 8)
    assert n.sum() == 481 and (first == np.concatenate([[0], np.cumsum(n)[:-1]])).all()
    again = repeats._spans(words[100:400], text[:300], ends[:300] - 200, 20, 8)
    inside = set(zip(anchor.tolist(), span.tolist()))
    assert len([1 for pair in zip(again[2].tolist(), again[3].tolist()) if pair in inside]) >= len(again[0]) - 2


def test_long_text_equals_one_step(spark, monkeypatch):
    rng = random.Random(9)
    block = [f"w{rng.randrange(50_000)}" for _ in range(3000)]
    rows = [(1, " ".join(block * 3)), (2, " ".join(block[::-1] + block)), (3, " ".join(block[:1500] + ["new"] + block[1500:]))]
    monkeypatch.setattr(repeats, "STEP_WORDS", 700)
    got = repeats.passage_digests(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(map(digest, plain(rows)))


def test_odd_rows(spark, oddities, nothing):
    rows = [(r.doc_id, r.text) for r in oddities.select("doc_id", "text").collect()]
    want = sorted(map(digest, plain(sorted(rows, key=repr))), key=repr)
    assert sorted((tuple(r) for r in repeats.passage_digests(oddities).collect()), key=repr) == want
    kept = repeats.remove_repeated_passages(oddities)
    assert kept.columns == oddities.columns and kept.count() == oddities.count()
    assert {r.text for r in kept.where("doc_id IN (4, 5, 6, 11)").collect()} == {r.text for r in oddities.where("doc_id IN (4, 5, 6, 11)").collect()}
    assert sorted(r.text for r in kept.where("doc_id = 2").collect()) == ["", "x y"]
    assert repeats.passage_digests(nothing).count() == 0 and repeats.remove_repeated_passages(nothing).columns == nothing.columns
