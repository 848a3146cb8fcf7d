import hashlib
import re

import pytest
from pyspark.sql import functions as F

from chunkwright.functions import ids, tokens
from chunkwright.functions.templates import compile_template
from chunkwright.functions.text import is_blank, strip, universal_newlines
from chunkwright.operators.requests import word_count

TEXTS = ["", " ", "a", "a  b\n", "\ttab\r\nnext\n\n", "é ü 日本 語\u3000x", "\u00a0nbsp\x85", "x\x1cy", "  lead", "end  ", "mixé日a b"]


def one(spark, rows, *cols):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, s string")
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


def test_strip_blank_words_match_python(spark):
    got = one(spark, TEXTS, strip(F.col("s")), is_blank(F.col("s")), word_count(F.col("s")))
    assert got == [(t.strip(), not t.strip(), len(t.split())) for t in TEXTS]


def test_universal_newlines(spark):
    assert one(spark, ["a\r\nb\rc\nd"], universal_newlines(F.col("s"))) == [("a\nb\nc\nd",)]


def test_hashes_match_hashlib(spark):
    got = one(spark, TEXTS, ids.sha256_hash(F.col("s")), ids.sha1_hash(F.col("s")))
    assert got == [
        ("sha256:" + hashlib.sha256(t.encode()).hexdigest(), hashlib.sha1(t.encode()).hexdigest()) for t in TEXTS
    ]


def test_chunk_id_keeps_empty_parts(spark):
    made = ids.chunk_id(F.lit("p"), F.lit(None).cast("string"), F.lit(3), F.lit("s"))
    (row,) = one(spark, ["x"], made)
    assert row[0] == "sha256:" + hashlib.sha256(b"p||3|s").hexdigest()


def test_stable_uuid_is_a_repeatable_v4(spark):
    made = ids.stable_uuid(F.col("s"), F.col("i"))
    first, second = (one(spark, TEXTS, made, ids.is_valid_uuid(made)) for _ in range(2))
    assert first == second and all(ok for _, ok in first)
    assert len({u for u, _ in first}) == len(TEXTS)


@pytest.mark.parametrize(
    "value, uuid_ok, run_ok",
    [
        ("123e4567-e89b-42d3-a456-426614174000", True, False),
        ("123E4567-E89B-42D3-A456-426614174000", False, False),
        ("123e4567-e89b-12d3-a456-426614174000", False, False),
        ("run_20240101_000000", False, True),
        ("run_20241399_996099", False, True),
        ("run_2024_01", False, False),
        (None, False, False),
    ],
)
def test_id_formats(spark, value, uuid_ok, run_ok):
    assert one(spark, [value], ids.is_valid_uuid(F.col("s")), ids.is_valid_run_id(F.col("s"))) == [(uuid_ok, run_ok)]


def test_run_id_is_utc(spark):
    assert one(spark, ["x"], ids.run_id(F.timestamp_seconds(F.lit(0)))) == [("run_19700101_000000",)]


def test_tokens_are_lossless_and_counted(spark):
    tk = tokens.encode(F.col("s"))
    got = one(spark, TEXTS, tokens.decode(tk), tokens.count_tokens(F.col("s")))
    assert got == [(t, len(re.findall(tokens.TOKEN_PATTERN, t))) for t in TEXTS]


def test_token_slices(spark):
    tk = tokens.encode(F.col("s"))
    assert one(spark, ["one two\nthree four"], tokens.decode(tk, 1, 4)) == [(" two\nthree",)]


def test_tokens_are_stable_at_line_starts(spark):
    text = "a b  \n  c\n\n\td e\n  \nf"
    starts = [m.end() for m in re.finditer("\n", text)]
    whole = re.findall(tokens.TOKEN_PATTERN, text)
    for start in starts:
        prefix = re.findall(tokens.TOKEN_PATTERN, text[:start])
        assert whole[: len(prefix)] == prefix


def test_unknown_tokenizer_is_an_error():
    with pytest.raises(ValueError):
        tokens.get_tokenizer("no-such")
    with pytest.raises(ValueError):
        tokens.register_tokenizer("nothing")
    own = tokens.register_tokenizer("chars", lambda c: F.split(c, ""))
    assert tokens.get_tokenizer("chars") is own and tokens.get_tokenizer(own) is own


def test_template(spark):
    made = compile_template("{{ a }}-{{b.c}} {{ gone }}.\n", {"a": F.col("s"), "b.c": 5})
    assert one(spark, ["x", None], made) == [("x-5 .",), ("-5 .",)]
    for markup in ("{% if a %}", "{{ a | upper }}", "{# c #}"):
        with pytest.raises(ValueError):
            compile_template(markup, {})
