import json

import pytest
from pyspark.sql import functions as F

from chunkwright.functions.ids import stable_uuid
from chunkwright.functions.rules import Rule, typed_errors, typed_valid, variant_errors
from chunkwright.operators import checks, outcomes
from chunkwright.operators.prompts import SOLUTION_BEGIN as SB
from chunkwright.operators.prompts import SOLUTION_END as SE
from chunkwright.operators.prompts import THOUGHT_BEGIN as TB
from chunkwright.operators.prompts import THOUGHT_END as TE
from chunkwright.operators.validation import ITEM_RULES, validate, validate_json
from chunkwright.schemas import CHECK_NAMES, ITEM_DDL, REPORT_DDL

STAMP = "2024-01-01T00:00:00Z"
CHUNK = "sha256:" + "a" * 64
CASES = [
    (f"{TB}r{TE}{SB}a{SE}", []),
    (f"{TB}r{SB}a{SE}", ["has_thought_end_token", "thought_tags_properly_paired", "thought_tags_properly_nested"]),
    (f"{TB}r{TE}{SB}a", ["has_solution_end_token", "solution_tags_properly_paired", "solution_tags_properly_nested"]),
    (
        "plain",
        ["has_thought_begin_token", "has_thought_end_token", "has_solution_begin_token", "has_solution_end_token", "tags_in_correct_order"],
    ),
    (f"{SB}a{SE}{TB}r{TE}", ["tags_in_correct_order"]),
    (f"{TE}r{TB}{SB}a{SE}", ["thought_tags_properly_nested"]),
    (f"{TB}r{TE}{SB}\\boxed{{4}}{SE}", []),
    (f"{TB}r{TE}{SB}a{SE}{SB}again{SE}", []),
]


def item(n, solution, **changes):
    base = {
        "id": f"{n:08x}-0000-4000-8000-{n:012x}",
        "system_prompt": "sys",
        "metadata": {
            "source": "s", "difficulty": "d", "subject": "x", "tags": ["t"], "project": "p", "file_path": "f",
            "file_name": "f", "chunk_index": n, "chunk_id": CHUNK,
        },
        "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}],
        "problem": "q",
        "solution": solution,
        "created_at": STAMP,
    }
    for path, value in changes.items():
        where, _, leaf = path.rpartition("__")
        (base[where] if where else base)[leaf] = value
    return base


def items(spark, records):
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    return lines.select(F.from_json("value", ITEM_DDL).alias("r")).select("r.*")


def test_tag_cases(spark):
    rows = checks.local_checks(items(spark, [item(i, s) for i, (s, _) in enumerate(CASES)])).collect()
    assert {r.metadata.chunk_index: r.errors for r in rows} == {i: e for i, (_, e) in enumerate(CASES)}
    assert tuple(rows[0].checks.asDict()) == CHECK_NAMES


def test_chosen_and_extra_checks(spark):
    base = items(spark, [item(0, "plain")])
    (row,) = checks.local_checks(
        base, checks=["json_schema_valid"], extra_checks={"long_enough": F.length("solution") > 10}
    ).collect()
    assert row.errors == ["long_enough"] and set(row.checks.asDict()) == {"json_schema_valid", "long_enough"}
    with pytest.raises(ValueError):
        checks.local_checks(base, checks=["no_such"])


MESSAGES = [
    ([{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], True),
    ([{"role": "assistant", "content": "q"}, {"role": "user", "content": "a"}], False),
    ([{"role": "user", "content": "q"}], False),
    ([{"role": "user", "content": "q"}] * 2 + [{"role": "assistant", "content": "a"}], False),
]


def test_message_shape(spark):
    rows = checks.local_checks(items(spark, [item(i, "s", messages=m) for i, (m, _) in enumerate(MESSAGES)])).collect()
    got = {r.metadata.chunk_index: r.checks.messages_shape_valid for r in rows}
    assert got == {i: ok for i, (_, ok) in enumerate(MESSAGES)}


BAD = [
    ({}, []),
    ({"id": "X"}, ["id"]),
    ({"problem": ""}, ["problem"]),
    ({"metadata__tags": ["", "b", ""]}, ["metadata.tags.0", "metadata.tags.2"]),
    ({"metadata__chunk_index": -1}, ["metadata.chunk_index"]),
    ({"metadata__chunk_id": "sha256:zz"}, ["metadata.chunk_id"]),
    ({"messages": [{"role": "tool", "content": ""}, {"role": "user", "content": "x"}]}, ["messages.0.role", "messages.0.content"]),
    ({"messages": []}, ["messages"]),
    ({"metadata__subject": ""}, ["metadata.subject"]),
]


def test_typed_and_json_rules_agree(spark):
    records = [item(0, "s", **changes) for changes, _ in BAD]
    typed = items(spark, records).select("*", typed_valid(ITEM_RULES, items(spark, records).schema).alias("ok"))
    typed = [(r.ok, [e.split(":")[0] for e in r.errors]) for r in validate(typed, "item", checks.ITEM_FIELDS).collect()]
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    by_json = [[e.split(":")[0] for e in r.errors] for r in validate_json(lines, "item").collect()]
    want = [paths for _, paths in BAD]
    assert [t for _, t in typed] == want and by_json == want
    assert [ok for ok, _ in typed] == [not paths for paths in want]


def test_json_rules_tell_missing_null_and_type_apart(spark):
    missing = item(0, "s")
    del missing["problem"]
    records = [
        missing,
        item(0, None),
        item(0, 5),
        {**item(0, "s"), "more": 1},
        item(0, "s", metadata__more="kept open"),
        item(0, "s", metadata__chunk_index=1.0),
        item(0, "s", metadata__chunk_index=1.5),
        item(0, "s", metadata__chunk_index=True),
    ]
    lines = spark.createDataFrame([(json.dumps(r),) for r in records] + [("{oops",)], "value string")
    assert [r.errors for r in validate_json(lines, "item").collect()] == [
        ["root: problem is a required property"],
        ["solution: not of type string"],
        ["solution: not of type string"],
        ["root: more is unexpected"],
        [],
        [],
        ["metadata.chunk_index: not of type integer"],
        ["metadata.chunk_index: not of type integer"],
        ["Invalid JSON"],
    ]


def test_map_rules(spark):
    rule = Rule("object", fields=(Rule("map", "m", min_properties=1, each=Rule("integer", minimum=0)),))
    rows = [({"a": 1},), ({"a": -1},), ({},), (None,)]
    df = spark.createDataFrame(rows, "m map<string,int>")
    typed = [r[0] for r in df.select(typed_errors(rule, df.schema)).collect()]
    text = df.select(F.to_json(F.struct("m"), {"ignoreNullFields": "true"}).alias("s"))
    as_json = [r[0] for r in text.select(variant_errors(rule, "parse_json(s)")).collect()]
    assert typed == as_json == [
        [], ["m.a: less than the minimum of 0"], ["m: fewer than 1 properties"], ["root: m is a required property"],
    ]


VERDICTS = [
    ("ok", '{"passed": true, "errors": []}', True, []),
    ("ok", '```json\n{"passed": false, "errors": ["e1", "e2"],}\n```', False, ["e1", "e2"]),
    ("ok", '{"errors": ["no verdict"]}', False, ["no verdict"]),
    ("ok", '{"passed": true}', True, []),
    ("ok", "cannot say", True, ["Verifier JSON parse error"]),
    ("ok", "[]", True, ["Model verification error: reply is no object"]),
    ("ok", '{"passed": false, "errors": "text"}', True, ["Model verification error: errors is no list"]),
    ("failed", None, True, ["Model verification error: Timeout: late"]),
    (None, None, True, ["Model verification error: no reply"]),
    ("ok", '{"passed": "false"}', True, []),
    ("ok", '{"passed": 0}', False, []),
    ("ok", '{"passed": null}', False, []),
]


def verdict_table(spark, ids):
    rows = [(i, s, c, "Timeout: late" if s == "failed" else None) for i, (s, c, _, _) in zip(ids, VERDICTS) if s]
    return checks.read_verdicts(spark.createDataFrame(rows, "request_id string, status string, content string, error string"))


def test_verdicts_merge(spark):
    records = [item(i, CASES[0][0]) for i in range(len(VERDICTS))]
    checked = checks.local_checks(items(spark, records))
    verdicts = verdict_table(spark, [r["id"] for r in records])
    reported = checks.merge_verdicts(checked, verdicts, STAMP)
    got = {r.metadata.chunk_index: (r.passed, r.verify_report.errors) for r in reported.collect()}
    assert got == {i: (p, e) for i, (_, _, p, e) in enumerate(VERDICTS)}
    closed = checks.merge_verdicts(checked, verdicts, STAMP, fail_open=False)
    assert {r.metadata.chunk_index: r.passed for r in closed.collect()}[4] is False
    report = reported.select("verify_report.*")
    assert validate(report, "report").where("NOT valid").count() == 0
    assert [f.name for f in report.schema] == [f.name for f in spark.createDataFrame([], REPORT_DDL).schema]


def test_local_errors_skip_the_model(spark):
    records = [item(0, CASES[0][0]), item(1, "plain")]
    checked = checks.local_checks(items(spark, records))
    assert [r.metadata.chunk_index for r in checks.needs_verdict(checked).collect()] == [0]
    reported = checks.merge_verdicts(checked, verdict_table(spark, [records[1]["id"]]), STAMP)
    row = reported.where("metadata.chunk_index = 1").first()
    assert row.passed is False and row.verify_report.errors == CASES[3][1]
    alone = checks.merge_verdicts(checked, None, STAMP)
    assert {r.metadata.chunk_index: r.passed for r in alone.collect()} == {0: True, 1: False}


def test_routing_and_counts(spark):
    records = [item(i, s, metadata__chunk_id="sha256:" + f"{i % 3:064x}") for i, (s, _) in enumerate(CASES)]
    reported = checks.merge_verdicts(checks.local_checks(items(spark, records)), None, STAMP)
    chunks = spark.createDataFrame([("sha256:" + f"{i:064x}",) for i in range(5)], "chunk_id string")
    stats = outcomes.chunk_stats(chunks, reported)
    totals = outcomes.run_totals(stats).first().asDict()
    assert totals == {
        "total_chunks": 5, "total_generated": 8, "total_verified": 3, "total_rejected": 5, "failed_chunks": 2,
        "verification_rate": 37.5,
    }
    assert [r.chunk_id[-1] for r in outcomes.first_failed_chunks(stats, 1).collect()] == ["3"]
    assert outcomes.verified_items(reported).count() == 3
    rejected = outcomes.rejected_items(reported)
    assert rejected.count() == 5 and rejected.columns == ["item", "verify_report"]
    histogram = {r.error: r["items"] for r in outcomes.error_histogram(reported).collect()}
    assert histogram["tags_in_correct_order"] == 2
    empty = outcomes.run_totals(stats.where("false")).first()
    assert empty.total_chunks == 0 and empty.verification_rate is None


def test_stable_ids_differ_by_position(spark):
    a, b = spark.range(1).select(stable_uuid(F.lit(CHUNK), F.lit(0)), stable_uuid(F.lit(CHUNK), F.lit(1))).first()
    assert a != b


def test_tags_behind_wide_characters_and_one_projection(spark):
    thought, answer = "<|begin_of_thought|>\U0001f600<|end_of_thought|>", "<|begin_of_solution|>a<|end_of_solution|>"
    checked = checks.local_checks(items(spark, [item(0, "\U0001f600" * 9 + thought + answer), item(1, answer + thought)]))
    assert {r.metadata.chunk_index: r.errors for r in checked.collect()} == {0: [], 1: ["tags_in_correct_order"]}
    assert checked._jdf.queryExecution().executedPlan().toString().count("Generate ") == 1
