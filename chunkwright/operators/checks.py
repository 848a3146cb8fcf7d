"""Local checks of items and the merge with a model's verdict."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.functions.jsonfix import parse_reply
from chunkwright.functions.text import empty_array
from chunkwright.operators.prompts import SOLUTION_BEGIN, SOLUTION_END, THOUGHT_BEGIN, THOUGHT_END
from chunkwright.operators.validation import record_valid
from chunkwright.schemas import CHECK_NAMES
from chunkwright.session import once

ITEM_FIELDS = ["id", "system_prompt", "metadata", "messages", "problem", "solution", "created_at"]


def tag_positions() -> dict[str, Column]:
    """Where the four tags stand in ``solution``, in their order; 0 for a tag that it lacks.

    Places count UTF-16 units from 1.  `instr` would compare at every character; the regex engine skips along.
    """
    solution = F.coalesce(F.col("solution"), F.lit(""))
    tags = {"_tb": THOUGHT_BEGIN, "_te": THOUGHT_END, "_sb": SOLUTION_BEGIN, "_se": SOLUTION_END}
    return {n: F.regexp_instr(solution, F.lit(re.escape(tag))) for n, tag in tags.items()}


def messages_shape() -> Column:
    """Whether ``messages`` are one of the user and one of the assistant."""
    roles = F.transform("messages", lambda m: m["role"])
    return F.coalesce(roles == F.array(F.lit("user"), F.lit("assistant")), F.lit(False))


def check_columns(
    schema_valid: Column, positions: Mapping[str, Column] | None = None, shape_valid: Column | None = None
) -> dict[str, Column]:
    """The twelve checks by name, in report order, over the columns of an item row."""
    tb, te, sb, se = (positions or tag_positions()).values()

    def nested(begin: Column, end: Column) -> Column:
        return F.when((begin > 0) & (end > 0), begin < end).otherwise((begin > 0) == (end > 0))

    values = {
        "json_schema_valid": schema_valid,
        "messages_shape_valid": shape_valid if shape_valid is not None else messages_shape(),
        "has_thought_begin_token": tb > 0,
        "has_thought_end_token": te > 0,
        "thought_tags_properly_paired": (tb > 0) == (te > 0),
        "has_solution_begin_token": sb > 0,
        "has_solution_end_token": se > 0,
        "solution_tags_properly_paired": (sb > 0) == (se > 0),
        "tags_in_correct_order": (tb > 0) & (sb > 0) & (tb < sb),
        "thought_tags_properly_nested": nested(tb, te),
        "solution_tags_properly_nested": nested(sb, se),
        "final_answer_boxed_if_required": F.lit(True),
    }
    return {name: values[name] for name in CHECK_NAMES}


def local_checks(
    items: DataFrame,
    checks: Sequence[str] | None = None,
    extra_checks: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``checks``, a struct of booleans, and ``errors``, the failed names in order.

    All checks run unless ``checks`` selects some; ``extra_checks`` adds named boolean
    columns of your own.
    """
    at = tag_positions()
    known = check_columns(F.col("_schema_valid"), {name: F.col(name) for name in at}, F.col("_shape_valid"))
    unknown = set(checks or ()) - set(known)
    if unknown:
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    chosen = {name: c for name, c in known.items() if checks is None or name in checks}
    own = {f"_own_{n}": c for n, c in enumerate((extra_checks or {}).values())}
    chosen.update(zip(extra_checks or {}, map(F.col, own)))
    valid = record_valid("item", items.select(*ITEM_FIELDS).schema)
    # What looks at the texts is computed once; the checks themselves only compare its results.
    tested = once(items, {"_schema_valid": valid, "_shape_valid": messages_shape(), **at, **own})
    judged = tested.withColumn("checks", F.struct(*[c.alias(name) for name, c in chosen.items()])).drop(
        "_schema_valid", "_shape_valid", *at, *own
    )
    failed = F.array(*[F.when(~F.col(f"checks.{name}"), F.lit(name)) for name in chosen])
    return judged.withColumn("errors", F.array_except(failed, F.array(F.lit(None).cast("string"))))


def needs_verdict(checked: DataFrame) -> DataFrame:
    """Items that go on to the model: those without a local error."""
    return checked.where(F.size("errors") == 0)


def read_verdicts(replies: DataFrame) -> DataFrame:
    """Verdicts ``(request_id, model_passed, model_errors, model_note)`` of verifier replies.

    A reply that failed or cannot be read leaves ``model_passed`` NULL and says why in
    ``model_note``.  A missing verdict counts as not passed, a missing error list as empty.
    """
    read = once(replies, {"_reply": parse_reply(F.col("content"))})
    parsed = read.select("request_id", "status", "error", F.col("_reply.value").alias("_v"))
    fields = F.try_variant_get("_v", "$", "map<string,variant>")
    listed = F.try_variant_get("_v", "$.errors", "variant")
    errors = F.try_variant_get("_v", "$.errors", "array<string>")
    note = (
        F.when(F.col("status") == "failed", F.concat(F.lit("Model verification error: "), F.col("error")))
        .when(F.col("_v").isNull(), "Verifier JSON parse error")
        .when(fields.isNull(), "Model verification error: reply is no object")
        .when(listed.isNotNull() & errors.isNull(), "Model verification error: errors is no list")
    )
    # Any value but these counts as a pass: the verdict's truth is that of its JSON value.
    passed = F.try_variant_get("_v", "$.passed", "variant")
    truth = passed.isNotNull() & ~F.to_json(passed).isin("false", "null", "0", "0.0", '""', "[]", "{}")
    return once(parsed, {"model_note": note}).select(
        "request_id",
        F.when(F.col("model_note").isNull(), F.coalesce(truth, F.lit(False))).alias("model_passed"),
        F.when(F.col("model_note").isNull(), F.coalesce(errors, empty_array("string"))).alias("model_errors"),
        "model_note",
    )


def merge_verdicts(
    checked: DataFrame, verdicts: DataFrame | None, created_at: Column | str, fail_open: bool = True
) -> DataFrame:
    """Final report per item: adds ``passed`` and ``verify_report``.

    An item passes when it has no local error and the model did not reject it.  Without a
    readable verdict the local result stands (``fail_open``) and a note joins the errors.
    """
    stamp = created_at if isinstance(created_at, Column) else F.lit(created_at)
    clean = F.size("errors") == 0
    if verdicts is None:
        merged = checked.withColumns({"passed": clean, "_errors": F.col("errors")})
    else:
        joined = checked.join(verdicts.withColumnRenamed("request_id", "id"), "id", "left")
        note = F.when(
            clean & F.col("model_passed").isNull(),
            F.array(F.coalesce("model_note", F.lit("Model verification error: no reply"))),
        )
        empty = empty_array("string")
        merged = joined.withColumns(
            {
                "passed": clean & F.coalesce("model_passed", F.lit(fail_open)),
                "_errors": F.concat(
                    F.col("errors"),
                    F.when(clean, F.coalesce("model_errors", empty)).otherwise(empty),
                    F.coalesce(note, empty),
                ),
            }
        )
    report = F.struct(
        F.col("id").alias("input_item_id"),
        F.col("metadata.chunk_id").alias("chunk_id"),
        F.col("passed"),
        F.col("_errors").alias("errors"),
        F.col("checks"),
        stamp.alias("created_at"),
    )
    return merged.select(*ITEM_FIELDS, "passed", report.alias("verify_report"))
