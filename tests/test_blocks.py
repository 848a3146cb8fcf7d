"""Chunks of texts in blocks against the fold over whole texts."""

import random

import pytest

from chunkwright.operators.blocks import block_tasks, chunk_blocks, text_blocks
from chunkwright.operators.chunking import ChunkOptions, chunk_spans

LINES = ["# head", "", "   ", "===", "---", " == ", "- item", "plain words here", "a b c d e f g h i j k l m n o p", "=== x", "é 漢字 \U0001f642", "x", "\t#tab", "----------"]


def _texts(seed):
    rng = random.Random(seed)
    rows = [(0, ""), (1, "\n"), (2, "one"), (3, "word " * 3000), (4, "a\n" * 900), (5, "\n\n\n" * 200), (6, "t\n===\n" * 300), (7, "# h\n" * 300 + "x " * 700)]
    for n in range(8, 60):
        text = "\n".join(rng.choice(LINES) for _ in range(rng.randint(1, 300)))
        rows.append((n, text + rng.choice(["", "\n", "\n\n"])))
    return rows


@pytest.mark.parametrize("options,block_chars", [
    (ChunkOptions(16, 2, 25), 40), (ChunkOptions(16, 2, 25), 700), (ChunkOptions(7, 1, 30), 1), (ChunkOptions(64, 8, 10), 100),
    (ChunkOptions(64, 8, semantic_breaks=False), 90), (ChunkOptions(5, 0, 0), 33), (ChunkOptions(400, 100, 50), 60),
])
def test_blocks_equal_the_fold(spark, options, block_chars):
    df = spark.createDataFrame(_texts(block_chars), "n int, text string")
    shape = ["n", "chunk_index", "total_chunks", "token_start", "token_end", "text"]
    got = chunk_blocks(text_blocks(df, block_chars), ["n"], options).select(*shape).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, chunk_spans(df, options).select(*shape).collect()))


def test_blocks_rejoin_and_begin_at_line_starts(spark):
    rows = _texts(3)
    df = spark.createDataFrame([(n, t, None) for n, t in rows] + [(99, None, "x")], "n int, text string, block string").drop("block")
    parts = {}
    for r in sorted(text_blocks(df, 50).collect(), key=lambda r: (r.n, r.block)):
        assert r.block == len(parts.setdefault(r.n, []))
        assert not parts[r.n] or parts[r.n][-1].endswith("\n")
        parts[r.n].append(r.text)
    assert {n: "".join(p) for n, p in parts.items()} == {n: t for n, t in rows if t}


def test_other_tokenizers_are_refused(spark):
    from chunkwright.functions.tokens import register_tokenizer
    from pyspark.sql import functions as F

    register_tokenizer("letters", encode=lambda text: F.split(text, ""))
    with pytest.raises(ValueError):
        chunk_blocks(text_blocks(spark.createDataFrame([(1, "a")], "n int, text string")), ["n"], ChunkOptions(tokenizer="letters"))


def test_a_corpus_with_large_texts_has_the_same_chunks(spark, tmp_path):
    from chunkwright.plans.chunk_corpus import chunk_corpus
    from chunkwright.sources.jsonl import read_chunks

    for n, text in _texts(6)[:30]:
        path = tmp_path / "in" / f"p{n % 2}" / f"{n}.md"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    found = []
    for large in (200, 1 << 30):
        work = str(tmp_path / f"work{large}")
        totals = sorted(map(str, chunk_corpus(spark, str(tmp_path / "in"), work, ChunkOptions(16, 2, 25), "2024-01-01T00:00:00Z", large).collect()))
        found.append((totals, sorted(map(str, read_chunks(spark, f"{work}/chunks").collect()))))
    assert found[0] == found[1] and len(found[0][1]) > 100


def test_short_blocks_share_tasks():
    # 0.1 GB in blocks of 1,500 characters: one task for every 64 of them made 1,784 tasks.
    assert block_tasks(114_000, 170_000_000, 8) == 16
    assert block_tasks(2, 40 << 30, 8) == 2561 and block_tasks(10_000_000, 1, 8) == 501 and block_tasks(0, 0, 4) == 8


def test_blocks_travel_in_batches(spark):
    df = spark.createDataFrame([(1, "a\n" * 500), (2, ""), (3, None), (4, "b")], "n int, text string").coalesce(1)
    sizes = text_blocks(df, 2).mapInArrow(lambda batches: batches, "n int, block int, text string")
    rows = [(r.n, r.block, r.text) for r in sizes.collect()]
    assert rows == [(1, i, "a\n") for i in range(500)] + [(4, 0, "b")]
