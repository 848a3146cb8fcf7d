"""Rule checks of chunks, items, reports and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright import schemas
from chunkwright.functions.ids import CHUNK_ID_PATTERN, RUN_ID_PATTERN, SHA1_PATTERN, UUID_PATTERN
from chunkwright.functions.jsonfix import parse_strict
from chunkwright.functions.rules import Rule, typed_errors, typed_valid, variant_errors
from chunkwright.session import once


def _text(name: str = "", **kw) -> Rule:
    return Rule("string", name, **{"min_length": 1, **kw})


def _count(name: str, minimum: int = 0, **kw) -> Rule:
    return Rule("integer", name, minimum=minimum, **kw)


# The fields of each record and what they must satisfy.
CHUNK_RULES = Rule(
    "object",
    closed=True,
    fields=(
        Rule("string", "chunk_id", pattern=CHUNK_ID_PATTERN),
        _text("project"),
        _text("file_path"),
        _text("file_name"),
        _count("chunk_index"),
        _count("total_chunks", minimum=1),
        _count("token_start"),
        _count("token_end"),
        _text("text"),
        Rule(
            "object",
            "metadata",
            closed=True,
            fields=(
                _text("project_name"),
                Rule("string", "source_format", allowed=schemas.SOURCE_FORMATS),
                Rule("string", "created_at"),
                Rule("string", "file_sha1", required=False, pattern=SHA1_PATTERN),
                Rule("string", "tokenizer", required=False),
                Rule("map", "extra", required=False),
            ),
        ),
    ),
)
ITEM_RULES = Rule(
    "object",
    closed=True,
    fields=(
        Rule("string", "id", pattern=UUID_PATTERN),
        _text("system_prompt"),
        Rule(
            "object",
            "metadata",
            fields=(
                _text("source"),
                _text("difficulty"),
                _text("subject"),
                Rule("array", "tags", each=_text()),
                Rule("string", "project", required=False),
                Rule("string", "file_path", required=False),
                Rule("string", "file_name", required=False),
                _count("chunk_index", required=False),
                Rule("string", "chunk_id", required=False, pattern=CHUNK_ID_PATTERN),
            ),
        ),
        Rule(
            "array",
            "messages",
            min_items=2,
            each=Rule(
                "object", closed=True, fields=(Rule("string", "role", allowed=schemas.ROLES), _text("content"))
            ),
        ),
        _text("problem"),
        _text("solution"),
        Rule("string", "created_at"),
    ),
)
REPORT_RULES = Rule(
    "object",
    closed=True,
    fields=(
        Rule("string", "input_item_id", pattern=UUID_PATTERN),
        Rule("string", "chunk_id", pattern=CHUNK_ID_PATTERN),
        Rule("boolean", "passed"),
        Rule("array", "errors", each=_text()),
        Rule(
            "object",
            "checks",
            fields=(
                Rule("boolean", "json_schema_valid"),
                Rule("boolean", "messages_shape_valid"),
                Rule("boolean", "content_consistent_with_chunk", required=False),
                Rule("boolean", "has_thought_token", required=False),
                Rule("boolean", "has_solution_token", required=False),
            ),
        ),
        Rule("string", "created_at"),
    ),
)
MANIFEST_RULES = Rule(
    "object",
    closed=True,
    fields=(
        Rule("string", "run_id", pattern=RUN_ID_PATTERN),
        Rule("string", "created_at"),
        _count("total_items"),
        Rule(
            "map",
            "splits",
            min_properties=1,
            each=Rule(
                "object",
                closed=True,
                fields=(
                    _count("num_items"),
                    Rule(
                        "array",
                        "shards",
                        min_items=1,
                        each=Rule("object", closed=True, fields=(_text("file"), _count("num_items"))),
                    ),
                ),
            ),
        ),
        Rule("map", "config", required=False),
    ),
)
RULES = {"chunk": CHUNK_RULES, "item": ITEM_RULES, "report": REPORT_RULES, "manifest": MANIFEST_RULES}


def record_errors(kind: str, schema: T.StructType) -> Column:
    """Error array of the row's own columns as a record of the given kind."""
    return typed_errors(RULES[kind], schema)


def record_valid(kind: str, schema: T.StructType) -> Column:
    """Whether the row's own columns form a valid record of the given kind."""
    return typed_valid(RULES[kind], schema)


def validate(df: DataFrame, kind: str, columns: list[str] | None = None) -> DataFrame:
    """Add ``errors`` and ``valid`` for rows that are records of the given kind.

    ``columns`` names the columns that form the record; the others pass through.
    """
    schema = df.select(*columns).schema if columns else df.schema
    checked = once(df, {"errors": record_errors(kind, schema)})
    return checked.withColumn("valid", F.size("errors") == 0)


def validate_json(df: DataFrame, kind: str, line: str = "value") -> DataFrame:
    """Add ``errors`` and ``valid`` for JSON texts; a text that does not parse has one error."""
    parsed = once(df, {"_record": parse_strict(F.col(line))})
    errors = F.when(F.col("_record").isNull(), F.array(F.lit("Invalid JSON"))).otherwise(
        variant_errors(RULES[kind], "_record")
    )
    return once(parsed, {"errors": errors}).withColumn("valid", F.size("errors") == 0).drop("_record")


def require_valid(df: DataFrame, kind: str) -> DataFrame:
    """The rows unchanged; the job fails at the first record that breaks a rule."""
    good = record_valid(kind, df.schema)
    why = F.concat(F.lit(f"Invalid {kind}: "), F.array_join(record_errors(kind, df.schema), "; "))
    return df.where(F.when(good, F.lit(True)).otherwise(F.raise_error(why).cast("boolean")))


def file_report(lines: DataFrame, kind: str) -> DataFrame:
    """Valid and invalid record counts per file, for ``numbered_lines`` input."""
    return (
        validate_json(lines, kind)
        .groupBy("file")
        .agg(F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"))
    )


def file_errors(lines: DataFrame, kind: str) -> DataFrame:
    """One row per bad line: file, line number and its message."""
    message = F.concat(F.lit("Line "), F.col("line").cast("string"), F.lit(": "), F.array_join("errors", "; "))
    return validate_json(lines, kind).where(~F.col("valid")).select("file", "line", message.alias("error"))
