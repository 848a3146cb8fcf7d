"""Faults and their places in JSON against Python's parser."""

import json
import random
import time

from pyspark.sql import functions as F

from chunkwright.functions.jsonscan import json_fault

CASES = [
    None, "", "  ", "\n \n", "[1,]", "[1, ]", '{"a":1,}', '{"a":1 ,\n }', '{"a"', '{"a":', '{"a":1', "{", "[", "[1", "[1,", '{"a" 1}', "{a:1}", '{"a":1 "b"}',
    "1 2", '{"a":1} x', '"abc', '"ab\\', '"a\\q"', '"a\\u12g4"', '"a\\u12', '"a\\u', '"a\nb"', '["a\tb"]', "-", "1.", "01", "[1.e3]", "tru", "[nul]", "{'a':1}",
    '{"a":1,,}', "[,1]", "﻿1", '"a\\ud83d"', '{"a\\x":1}', "]", "{]", "[}", "[}]", '{"a":]', "-0", "-01", "1e5x", '[[{"a":[]}]]', "[1]]", '"\x7f\x80"', '"\U0001f642" x',
    " [1]", '{"é\n":1}', "[\r\n1\r2]", "truefalse", "[true false]", '{"a":1}}', "\t1", "\x0c1", '"\\"', '"\\\\"', '"\\\\\\"', "1E+2", "[+1]", '{"a":"b" : 1}', '[":"]',
]


def python_fault(text):
    try:
        json.loads(text or "")
    except json.JSONDecodeError as error:
        return error.msg, error.lineno, error.colno
    return None


def faults(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, s string")
    rows = sorted(df.select("n", json_fault(F.col("s")).alias("f")).collect())
    return [None if r.f is None else tuple(r.f) for r in rows]


def test_faults_are_pythons(spark):
    assert list(zip(CASES, faults(spark, CASES))) == [(t, python_fault(t)) for t in CASES]


def test_damaged_texts(spark):
    rng = random.Random(11)

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        if kind == 0:
            return rng.choice([0, -3, 1.5, 10**30, 2e-9])
        if kind in (1, 2):
            return "".join(rng.choice(["a", "é", '"', "\\", "\n", " ", "\U0001f642", "\t", "{", "]", ","]) for _ in range(rng.randrange(6)))
        if kind == 3:
            return rng.choice([True, False, None])
        return [value(depth - 1) for _ in range(rng.randrange(4))] if kind < 6 else {f"k{i}": value(depth - 1) for i in range(rng.randrange(4))}

    texts = []
    for _ in range(1500):
        text = json.dumps(value(4), ensure_ascii=rng.random() < 0.3, indent=rng.choice([None, 1]))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text = rng.choice([text[:at], text[:at] + text[at + 1 :], text[:at] + rng.choice('[]{},:"\\\nu0x -') + text[at:]])
        texts.append(text)
    got, want = faults(spark, texts), [python_fault(t) for t in texts]
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w] == []
    assert 300 < sum(w is not None for w in want) < 1300


def test_constants_that_are_no_json(spark):
    assert faults(spark, ["NaN", "[1, -Infinity]"]) == [("Expecting value", 1, 1), ("Expecting value", 1, 5)]


def test_long_texts_take_linear_time(spark):
    def seconds(n):
        text = "[" + ", ".join('{"key": "some \\u00e9 text", "n": [1, 2.5, null]}' for _ in range(n)) + ", ]"
        begin = time.perf_counter()
        assert faults(spark, [text]) == [python_fault(text)]
        return time.perf_counter() - begin, len(text)

    seconds(10)
    (short, _), (long, size) = seconds(2_000), seconds(16_000)
    assert size > 600_000 and long < 30 * max(short, 0.2)
    whole = '"' + "x\\n" * 300_000
    assert faults(spark, [whole + '"', whole, whole + "\t"]) == [None, ("Unterminated string starting at", 1, 1), ("Invalid control character at", 1, 900_002)]


def test_nothing_behind_the_first_odd_character_is_scanned(spark):
    from chunkwright.functions import jsonscan

    texts = [("Here: [1, 2]", 0), ('[1, "a"] `x`', 7), ('["\\q long text"]', 1), ("", 0)]
    rows = spark.createDataFrame(texts, "text string, n int")
    found = rows.select("n", F.size(F.regexp_extract_all("text", F.lit(jsonscan._TOKEN), F.lit(0))).alias("size")).collect()
    assert [r["size"] for r in found] == [r.n for r in found]
