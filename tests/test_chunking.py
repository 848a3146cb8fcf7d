import random
import re

import pytest
from pyspark.sql import functions as F

from chunkwright.functions.tokens import TOKEN_PATTERN, Tokenizer, register_tokenizer
from chunkwright.operators.chunking import (
    ChunkOptions,
    chunk_documents,
    chunk_spans,
    corpus_totals,
    project_stats,
    semantic_breaks,
)
from chunkwright.operators.validation import require_valid, validate

STAMP = "2024-01-01T00:00:00Z"


def brute_breaks(text):
    """Every offset that satisfies one of the three break rules, line by line."""
    found, lines = set(), text.split("\n")
    starts = [sum(len(x) + 1 for x in lines[:i]) for i in range(len(lines))]
    for i, line in enumerate(lines):
        bare = line.strip()
        if bare.startswith("#"):
            found.add(starts[i])
        elif i and re.fullmatch("=+|-+", bare):
            found.add(starts[i - 1])
        elif not bare and starts[i] > 0:
            found.add(starts[i])
    return sorted(found)


def brute_spans(text, size, overlap, tol, semantic=True):
    """Chunk spans straight from the definition, on token end offsets."""
    ends = [0] + [m.end() for m in re.finditer(TOKEN_PATTERN, text)]
    n, spans, start = len(ends) - 1, [], 0
    marks = brute_breaks(text) if semantic else []
    while n:
        end = min(start + size, n)
        if end < n:
            near = [b for b in marks if ends[max(0, end - tol)] <= b <= ends[min(n, end + tol)]]
            if near:
                pick = min(near, key=lambda b: (abs(b - ends[end]), b))
                end = len(re.findall(TOKEN_PATTERN, text[:pick]))
        spans.append((start, end, text[ends[start] : ends[end]]))
        if end >= n:
            return spans
        start = end - overlap
    return spans


def random_text(rng):
    parts = ["word", " two words", "\n", "\n\n", "# Head\n", "===\n", " --- \n", "x" * 30, "\t", "é日本 ", "\n#tag\n", "  \n", "-", "="]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(0, 160)))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    fixed = ["", "\n", "#", "\n\n", "a", "a\n===", "===\n", "a\n---\n\nb", "# h\n\n\n# k", "w " * 500, "x\n" * 200]
    return fixed + [random_text(rng) for _ in range(150)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(4, "i")


def test_breaks_match_brute_force(spark, texts):
    rows = frame(spark, texts).select("i", semantic_breaks(F.col("text")).alias("b")).collect()
    assert {r.i: r.b for r in rows} == {i: brute_breaks(t) for i, t in enumerate(texts)}


def test_many_breaks_cross_blocks(spark):
    text = "a\n\n" * 2000
    (row,) = frame(spark, [text]).select(semantic_breaks(F.col("text")).alias("b")).collect()
    assert row.b == brute_breaks(text) and len(row.b) > 1024


@pytest.mark.parametrize(
    "size, overlap, pct, semantic",
    [(64, 8, 10, True), (10, 2, 30, True), (7, 0, 80, True), (5, 4, 0, True), (20, 5, 50, True), (16, 3, 10, False), (1, 0, 0, True)],
)
def test_chunks_match_brute_force(spark, texts, size, overlap, pct, semantic):
    opt = ChunkOptions(size, overlap, pct, semantic)
    got = {}
    for r in chunk_spans(frame(spark, texts), opt).collect():
        got.setdefault(r.i, {})[r.chunk_index] = (r.token_start, r.token_end, r.text, r.total_chunks)
    for i, text in enumerate(texts):
        want = brute_spans(text, size, overlap, opt.tolerance, semantic)
        have = [got.get(i, {})[k] for k in range(len(got.get(i, {})))]
        assert [h[:3] for h in have] == want, repr(text)
        assert all(h[3] == len(want) for h in have)
        assert all(h[1] - h[0] <= size + opt.tolerance for h in have)


def test_overlap_stripped_chunks_rejoin(spark, texts):
    opt = ChunkOptions(20, 5, 20)
    rows = chunk_spans(frame(spark, texts), opt).orderBy("i", "chunk_index").collect()
    built = {}
    for r in rows:
        skip = opt.overlap if r.chunk_index else 0
        built[r.i] = built.get(r.i, "") + "".join(re.findall(TOKEN_PATTERN, r.text)[skip:])
    assert built == {i: t for i, t in enumerate(texts) if t}


def test_result_does_not_depend_on_partitions(spark, texts):
    opt = ChunkOptions(20, 5, 20)
    a, b = (
        sorted(map(tuple, chunk_spans(frame(spark, texts).repartition(n), opt).collect())) for n in (1, 7)
    )
    assert a == b


def test_one_very_long_line(spark):
    text = "word " * 120_000
    opt = ChunkOptions(64, 8, 10)
    row = chunk_spans(frame(spark, [text]), opt).agg(F.count("*").alias("n"), F.max("token_end").alias("e")).first()
    want = brute_spans(text, 64, 8, 6)
    assert (row.n, row.e) == (len(want), want[-1][1])


@pytest.mark.parametrize("size, overlap, pct", [(10, 9, 10), (10, 10, 0), (0, 0, 0), (10, -1, 0)])
def test_settings_that_cannot_advance_are_refused(size, overlap, pct):
    with pytest.raises(ValueError):
        ChunkOptions(size, overlap, pct)


def documents(spark):
    rows = [
        ("p", "a/x.md", "x.md", "# T\n\nbody text\n", "0" * 40),
        ("p", "b/x.md", "x.md", "", "1" * 40),
        ("q", "x.md", "x.md", "one two three", "2" * 40),
    ]
    return spark.createDataFrame(rows, "project string, file_path string, file_name string, text string, file_sha1 string")


def test_records_are_valid_and_empty_files_count(spark):
    docs = documents(spark)
    made = chunk_documents(docs, ChunkOptions(64, 8, 10), STAMP)
    assert require_valid(made, "chunk").count() == 2
    assert validate(made, "chunk").where("NOT valid").count() == 0
    totals = {tuple(r) for r in corpus_totals(project_stats(docs, made)).collect()}
    assert totals == {("p", 1, 2, 1), ("q", 1, 1, 1), (None, 2, 3, 2)}


def test_require_valid_fails_the_job(spark):
    made = chunk_documents(documents(spark), ChunkOptions(64, 8, 10), STAMP).withColumn("project", F.lit(""))
    with pytest.raises(Exception, match="project: shorter than 1"):
        require_valid(made, "chunk").collect()


def test_same_named_files_get_different_ids(spark):
    docs = documents(spark).withColumn("text", F.lit("same")).withColumn("file_sha1", F.lit("3" * 40))
    made = chunk_documents(docs, ChunkOptions(64, 8, 10), STAMP)
    assert made.select("chunk_id").distinct().count() == 3


def test_tokenizer_from_an_arrow_function(spark):
    @F.pandas_udf("array<array<string>>")
    def triples(pieces):
        return pieces.map(lambda ps: [[p[i : i + 3] for i in range(0, len(p), 3)] for p in ps])

    own = register_tokenizer("triples", encode_pieces=triples)
    text = "abcdefgh\n\n# head\n" + "xyz" * 20
    rows = chunk_spans(frame(spark, [text, ""]), ChunkOptions(6, 1, 40, tokenizer="triples")).orderBy("chunk_index").collect()
    assert rows[0].text == "abcdefgh\n\n" and rows[-1].text.endswith("xyz")
    counted = frame(spark, ["abcd"]).select(F.size(own.encode(F.col("text")))).first()[0]
    assert counted == 2


def test_lossy_tokenizer_is_refused(spark):
    words = Tokenizer("words-only", lambda t: F.split(t, " "), lambda texts: F.transform(texts, lambda t: F.split(t, " ")))
    made = chunk_spans(spark.createDataFrame([("k", "one two, three")], "key string, text string"), ChunkOptions(tokenizer=words))
    with pytest.raises(Exception, match="do not rejoin"):
        made.collect()
