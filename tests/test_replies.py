import json
import random
import re

import pytest
from pyspark.sql import functions as F

from chunkwright.functions.jsonfix import (
    drop_trailing_commas,
    extract_fenced,
    json_problem,
    parse_reply,
    parse_strict,
    repair_escapes,
)
from chunkwright.operators.replies import build_items, failed_replies, parse_replies, reply_elements, stage_stats
from chunkwright.session import once


def run(spark, texts, **cols):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    return [r.asDict() for r in df.select("i", *[c.alias(n) for n, c in cols.items()]).orderBy("i").collect()]


def parsed(spark, texts):
    p = parse_reply(F.col("s"))
    rows = run(spark, texts, stage=p["stage"], value=F.to_json(p["value"]))
    return [(r["stage"], None if r["value"] is None else json.loads(r["value"])) for r in rows]


_ESCAPE = re.compile(r'\\(["\\/bfnrt]|u[0-9a-fA-F]{4})|\\')


def plain_repair(text):
    return _ESCAPE.sub(lambda m: m[0] if m[1] else "\\\\", text)


def plain_commas(text):
    return re.sub(r",(\s*[}\]])", r"\1", text)


def plain_body(reply):
    """What stands in the first fence marked as JSON, else in the first one, else all of it."""
    text = reply.strip()
    for opening in ("```json", "```"):
        if opening in text:
            return text.split(opening, 1)[1].split("```", 1)[0].strip()
    return text


def no_constant(name):
    raise ValueError(name)


def plain_parse(reply):
    """Stage and value by Python's parser, tried on every form of the text in turn."""
    body = plain_body(reply)
    for stage, text in enumerate((body, plain_repair(body), plain_commas(body), plain_commas(plain_repair(body))), 1):
        try:
            return stage, json.loads(text, parse_constant=no_constant)
        except ValueError:
            continue
    return None, None


def escaped_texts(rng, number):
    """Objects whose text holds sound and broken escapes of every kind side by side."""
    sound = [r"\n", r"\t", r"\\", r"\"", r"\/", r"\u00e9", r"\b", r"\f", r"\r"]
    broken = [r"\d", r"\alpha", r"\u12", r"\uXYZW", r"\ ", r"\(", r"\N", r"\_", r"\1", r"\'"]
    plain = ["sum", " ", "é", "日", "x", "0", "{", "]", ","]
    for _ in range(number):
        yield '{"k": "' + "".join(rng.choice(rng.choice([sound, broken, plain])) for _ in range(rng.randrange(9))) + '"}'


def test_escape_repair(spark):
    texts = list(escaped_texts(random.Random(8), 300))
    rows = run(spark, texts, fixed=repair_escapes(F.col("s")), twice=repair_escapes(repair_escapes(F.col("s"))))
    assert [r["fixed"] for r in rows] == [plain_repair(t) for t in texts]
    assert all(r["fixed"] == r["twice"] for r in rows)
    found = parsed(spark, texts)
    assert found == [plain_parse(t) for t in texts]
    assert {stage for stage, _ in found} >= {1, 2}


def test_escape_repair_of_long_runs(spark):
    text = '{"a": "' + r"\n\q\\" * 100_000 + '"}'
    (row,) = run(spark, [text], v=F.length(F.try_variant_get(parse_reply(F.col("s"))["value"], "$.a", "string")))
    assert row["v"] == 400_000


def fenced_replies(rng, number, bodies):
    """Bodies with and without fences, marks, chatter, blanks and endings."""
    for _ in range(number):
        body, mark = rng.choice(bodies), rng.choice(["json", "json", "", "yaml\n"])
        before, after = rng.choice(["", "Sure:\n", "\n \n"]), rng.choice(["", "\nThat is all.", "\n```\nmore\n```", " "])
        match rng.randrange(4):
            case 0:
                yield before + body + after
            case 1:
                yield f"{before}```{mark}\n{body}\n```{after}"
            case 2:
                yield f"{before}```{mark}\n{body}"
            case _:
                yield f"{before}```\nother\n```\n```json{body}```{after}"


BODIES = [
    '{"q": 1}', '[{"q": "a"}, {"q": "b"}]', '[{"q": "a"}, ]', '{"q": [1, {"r": null,}],\n}', '{"q": "50\\% of \\pi"}', '[{"q": "\\sqrt{2}", },]',
    "[]", "{}", "", " ", "null", "-0.5e3", '"text"', '{"q": 1} and more', '{"q": 1}, {"q": 2}', '[1, 2', '{"q": }', "{'q': 1}", '{"q": Infinity}', "[NaN]",
    '{"q": 1, "q": [2]}', "[98765432109876543210987654321098]", '{"q": "tab\there"}', '{"q": "a, ]"}', "]", '{"q": "\U0001f680 漢"}', "[[[[]]], {}]",
]


def test_fences(spark):
    texts = list(fenced_replies(random.Random(4), 300, [b for b in BODIES if "`" not in b]))
    assert [r["x"] for r in run(spark, texts, x=extract_fenced(F.col("s")))] == [plain_body(t) for t in texts]


def test_robust_parse(spark):
    texts = BODIES + list(fenced_replies(random.Random(6), 400, BODIES))
    found = parsed(spark, texts)
    assert [(t, f) for t, f in zip(texts, found)] == [(t, plain_parse(t)) for t in texts]
    assert {stage for stage, _ in found} == {1, 2, 3, 4, None}


def test_parse_options(spark):
    p = parse_reply(F.col("s"), sanitize=False, extract=False)
    rows = run(spark, [r'{"a": "\q"}', '```json\n1\n```', "[1,]"], stage=p["stage"])
    assert [r["stage"] for r in rows] == [None, None, 3]


def test_random_values_survive_damage(spark):
    rng = random.Random(3)
    alphabet = ["a", "é", " ", '"', "\\", "\n", "{", "}", "[", "]", ":", "/", "日", "0", "'", "u00"]

    def value(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind == 0:
            return rng.randrange(-1000, 1000)
        if kind in (1, 2):
            return "".join(rng.choice(alphabet) for _ in range(rng.randrange(12)))
        if kind == 3:
            return rng.choice([True, False, None])
        if kind == 4:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {f"k{i}": value(depth - 1) for i in range(rng.randrange(4))}

    originals = [[value(3)] for _ in range(150)]
    plain = [json.dumps(v, ensure_ascii=False) for v in originals]
    damaged = plain + [f"```json\n{t}\n```" for t in plain] + [t[:-1] + " , ]" for t in plain]
    assert [v for _, v in parsed(spark, damaged)] == originals * 3


def test_problems(spark):
    texts = BODIES + [b[:-1] for b in BODIES] + ["\n\t "]

    def problem(text):
        try:
            json.loads(text, parse_constant=no_constant)
        except ValueError:
            return "INVALID" if text.strip() else "EMPTY"
        return None

    assert [r["p"] for r in run(spark, texts, p=json_problem(F.col("s")))] == [problem(t) for t in texts]
    assert run(spark, [None], p=json_problem(F.col("s")))[0]["p"] == "EMPTY"


def test_commas_go_inside_strings_too(spark):
    assert run(spark, ['{"a": "x, ]", "b": [1 , ]}'], x=drop_trailing_commas(F.col("s")))[0]["x"] == '{"a": "x ]", "b": [1  ]}'


REAL_WORLD = r"""```json
[
  {
    "problem": "Where is the file?",
    "solution": "<|begin_of_thought|>\nIt is at C:\Data\Admin\config.yaml\n<|end_of_thought|>\n<|begin_of_solution|>\n\\boxed{C}\n<|end_of_solution|>"
  },
  {
    "problem": "2 + 2",
    "solution": "<|begin_of_thought|>\n4\n<|end_of_thought|>\n<|begin_of_solution|>\n\\boxed{4}\n<|end_of_solution|>",
  }
]
```"""


def chunk_rows(spark, contents):
    rows = [(f"sha256:{i:064x}", "p", f"d/{i}.md", f"{i}.md", i, c) for i, c in enumerate(contents)]
    return spark.createDataFrame(
        rows, "chunk_id string, project string, file_path string, file_name string, chunk_index int, content string"
    )


CONTENTS = [
    REAL_WORLD,
    '{"problem": "p", "solution": "s"}',
    '[{"problem": "p"}, {"problem": null, "solution": "s"}, {"problem": 7, "solution": "s"}]',
    '[{"problem": "p", "solution": "s"}, "text"]',
    "not json",
    " \n",
    None,
    "7",
    "[]",
]


def test_elements_and_failures(spark):
    p = parse_replies(chunk_rows(spark, CONTENTS))
    failures = {r.chunk_index: r.failure for r in p.select("chunk_index", "failure").collect()}
    assert failures == {
        0: None, 1: None, 2: None, 3: "element is no object", 4: "no JSON", 5: "empty reply", 6: "empty reply",
        7: "element is no object", 8: None,
    }
    got = {
        (r.chunk_index, r.position): (r.problem, r.problem_is_text)
        for r in reply_elements(p).collect()
    }
    assert got == {
        (0, 0): ("Where is the file?", True), (0, 1): ("2 + 2", True), (1, 0): ("p", True),
        (2, 1): (None, False), (2, 2): ("7", False),
    }
    assert {r.stage: r.replies for r in stage_stats(p).collect()} == {0: 3, 1: 5, 4: 1}
    failed = {r.chunk_index: (r.json, r.raw) for r in failed_replies(p).collect()}
    assert failed[4] == ("INVALID", "not json") and failed[3][0] == "VALID" and failed[6] == ("EMPTY", None)


def test_items_carry_chunk_metadata(spark):
    p = parse_replies(chunk_rows(spark, CONTENTS[:2]))
    rows = build_items(reply_elements(p), "2024-01-01T00:00:00Z", "sys", {"subject": "math", "tags": ["a"]}).collect()
    assert len({r.id for r in rows}) == 3
    row = next(r for r in rows if r.metadata.chunk_index == 1)
    assert row.metadata.asDict() == {
        "source": "synthetic", "difficulty": "medium", "subject": "math", "tags": ["a"], "project": "p",
        "file_path": "d/1.md", "file_name": "1.md", "chunk_index": 1, "chunk_id": f"sha256:{1:064x}",
    }
    assert [tuple(m) for m in row.messages] == [("user", "p"), ("assistant", "s")]


def test_one_value_makes_up_the_whole_text_whatever_it_holds(spark):
    """The mark behind a text is no value of its own, spelled out or as escapes."""
    texts = {
        '[1, {"a": null}]': True, " 7 ": True, '"end-of-text"': True, '["x", "end-of-text"]': True, "null": True, '"\\u00e9"': True,
        "1, 2": False, '1, "end-of-text"': False, '1, "end-of-text"] x [': False, '1, "\\u0065nd-of-text"] x [': False, "1], [2": False,
        '{"a": 1}] [': False, '1, "b": 2': False, '1} x': False, "": False, " ": False, "1 x": False, '"end-of-text"] [': False, "[1": False,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.v for r in df.select("t", parse_strict(F.col("t")).isNotNull().alias("v")).collect()}
    assert found == texts


def test_expressions_run_once_stand_in_a_compiled_projection(spark):
    df = spark.createDataFrame([("a b",), (None,)], "t string")
    made = once(df, {"u": F.upper("t"), "n": F.size(F.transform(F.split("t", " "), F.length))})
    assert sorted(map(tuple, made.collect()), key=str) == [("a b", "A B", 2), (None, None, None)]
    plan = made._jdf.queryExecution().executedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate " in line)
    assert "upper(" in plan and "upper(" not in generate


def test_runs_of_backslashes_are_repaired_as_pairs(spark):
    def by_pairs(text):
        return re.sub(r'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})|\\', lambda m: m[0] if len(m[0]) > 1 else "\\\\", text)

    rng = random.Random(5)
    texts = ["".join(rng.choices(["\\", "\\\\", "n", "q", '"', "u12aF", "u12", ",", "]", " "], k=12)) for _ in range(300)]
    assert [r["v"] for r in run(spark, texts, v=repair_escapes(F.col("s")))] == [by_pairs(t) for t in texts]


def test_replies_and_elements_are_carried_through_one_projection_each(spark):
    replies = spark.createDataFrame([("c", '[{"problem": null, "solution": "s"}, {"solution": "t"}, {"problem": 7, "solution": {}}]')], "chunk_id string, content string")
    found = reply_elements(parse_replies(replies))
    assert [tuple(r) for r in found.orderBy("position").collect()] == [("c", 0, None, "s", False, True), ("c", 2, "7", "{}", False, False)]
    # One generator for the parse, one for the elements, one for their texts.
    assert found._jdf.queryExecution().executedPlan().toString().count("Generate ") == 3
