"""Tokenizers from vocabulary files against the library alone, one text at a time."""

import json

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chunkwright.functions.tokens import get_tokenizer
from chunkwright.functions.vocabulary import Vocabulary
from chunkwright.operators.chunking import ChunkOptions, chunk_documents, chunk_spans, semantic_breaks
from workload import fixtures as fx

PATH = public_tokenizers.path("byte_bpe_50k.json")
NAME = f"vocabulary:file={PATH}"
ODD = [
    None, "", "\n", "# a\n\n\n\n## b\n\n", "é漢漢\U0001f642\U0001f642 ﬁ\n\n  \n漢字漢字\n---\n", "a <|endoftext|> b\n\n<|endoftext|>",
    " \t\n \n\n x\n\n\n" * 40, "word " * 500 + "\n\n" + "漢字\n\n" * 200, "\U0001f642" * 300, "x\x85 \n\n\ny" * 50,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    with open(PATH, encoding="utf-8") as file:
        table = Vocabulary(file.read()).bytes
    encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    return encode, lambda ids: b"".join(table[i] for i in ids).decode("utf-8", "replace")


def plain_chunks(library, text, breaks, size, overlap, tolerance):
    """Chunk by chunk, every position from decoding and encoding whole prefixes."""
    encode, decode = library
    ids, found, start = encode(text or ""), [], 0
    while start < len(ids):
        end = min(start + size, len(ids))
        if end < len(ids):
            low, target, high = (len(decode(ids[:k])) for k in (max(0, end - tolerance), end, min(len(ids), end + tolerance)))
            near = [b for b in breaks if low <= b <= high]
            if near:
                end = len(encode(text[: min(near, key=lambda b: abs(b - target))]))
        found.append((start, end, decode(ids[start:end])))
        if end >= len(ids):
            break
        start = max(end - overlap, 0)
    return found


def _compare(spark, library, rows, options):
    df = spark.createDataFrame(rows, "n int, text string").repartition(8, "n")
    got = {}
    for r in chunk_spans(df, options).collect():
        got.setdefault(r.n, []).append((r.chunk_index, r.total_chunks, r.token_start, r.token_end, r.text))
    breaks = {r.n: r.b for r in df.select("n", semantic_breaks(F.col("text")).alias("b")).collect()}
    for n, text in rows:
        want = plain_chunks(library, text, breaks[n] or [], options.max_tokens, options.overlap, options.tolerance)
        assert sorted(got.get(n, [])) == [(i, len(want), *w) for i, w in enumerate(want)], text[:200]


def test_chunks_of_all_documents(spark, library):
    rows = [(r.doc_id, r.text) for r in fx.documents(spark, "/root/testdata/sf0.001").select("doc_id", "text").collect() if len(r.text) < 6000]
    assert len(rows) > 150
    _compare(spark, library, rows, ChunkOptions(64, 8, 10, tokenizer=NAME))


@pytest.mark.parametrize("size,overlap,percent", [(16, 2, 25), (7, 1, 30), (64, 0, 0)])
def test_chunks_of_odd_texts(spark, library, size, overlap, percent):
    _compare(spark, library, list(enumerate(ODD)), ChunkOptions(size, overlap, percent, tokenizer=NAME))


def test_encode_decode_count_and_ends(spark, library):
    encode, decode = library
    tokenizer = get_tokenizer(NAME)
    df = spark.createDataFrame(list(enumerate(ODD)), "n int, text string").withColumn("ids", tokenizer.encode(F.col("text")))
    told = df.select(
        "n", "text", "ids", tokenizer.count(F.col("text")).alias("count"), tokenizer.decode(F.col("ids")).alias("back"),
        tokenizer.decode(F.slice("ids", 2, 3)).alias("part"), tokenizer.token_ends(F.col("text")).alias("ends"),
    )
    for r in told.collect():
        if r.text is None:
            assert r.ids is r["count"] is r.back is r.part is r.ends is None
            continue
        ids = encode(r.text)
        assert (r.ids, r["count"], r.back, r.part) == (ids, len(ids), r.text, decode(ids[1:4]))
        assert r.ends == [len(decode(ids[: k + 1])) for k in range(len(ids))]


def test_long_texts_are_encoded_in_parts(library, monkeypatch):
    monkeypatch.setattr("chunkwright.functions.vocabulary.PART_CHARS", 50)
    with open(PATH, encoding="utf-8") as file:
        vocabulary = Vocabulary(file.read())
    for text in (t for t in ODD if t):
        assert vocabulary.ids(text).tolist() == library[0](text)


def test_metadata_names_the_tokenizer_and_bad_names_fail(spark, tmp_path):
    docs = fx.documents(spark, "/root/testdata/sf0.001").where("doc_id < 5")
    made = chunk_documents(docs, ChunkOptions(256, 16, tokenizer=NAME), fx.STAMP)
    assert {r.t for r in made.select(F.col("metadata.tokenizer").alias("t")).collect()} == {NAME}
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["normalizer"] = {"type": "Lowercase"}
    (tmp_path / "lower.json").write_text(json.dumps(spec))
    for name in ("vocabulary:", "vocabulary:path=x", f"vocabulary:file={tmp_path}/lower.json", "gpt2"):
        with pytest.raises(ValueError):
            get_tokenizer(name)


def test_ends_of_known_ids_need_no_second_encoding(spark):
    from workload.queries import QUERIES

    tokenizer = get_tokenizer(NAME)
    ids, text = tokenizer.encode(F.col("text")), F.col("text")
    both = spark.createDataFrame([(t,) for t in ODD], "text string").select("text", ids.alias("ids"), tokenizer.token_ends(text).alias("ends"))
    assert both.where(~tokenizer.token_ends(text, F.col("ids")).eqNullSafe(F.col("ends"))).count() == 0
    plan = QUERIES["vocabulary_tokens"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("run(text#") == 2 and "run(run(" not in plan  # encode, and the ends of its ids
