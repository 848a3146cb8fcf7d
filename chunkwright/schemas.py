"""Record types of the stages.  Timestamps stay ISO-8601 strings."""

from __future__ import annotations

# Field names and allowed values of the records.
CHUNK_DDL = (
    "chunk_id STRING, project STRING, file_path STRING, file_name STRING, chunk_index INT, "
    "total_chunks INT, token_start INT, token_end INT, text STRING, metadata STRUCT<"
    "project_name: STRING, source_format: STRING, created_at: STRING, file_sha1: STRING, "
    "tokenizer: STRING, extra: MAP<STRING, STRING>>"
)
MESSAGES_DDL = "ARRAY<STRUCT<role: STRING, content: STRING>>"
ITEM_METADATA_DDL = (
    "STRUCT<source: STRING, difficulty: STRING, subject: STRING, tags: ARRAY<STRING>, "
    "project: STRING, file_path: STRING, file_name: STRING, chunk_index: INT, chunk_id: STRING>"
)
ITEM_DDL = (
    f"id STRING, system_prompt STRING, metadata {ITEM_METADATA_DDL}, messages {MESSAGES_DDL}, "
    "problem STRING, solution STRING, created_at STRING"
)
CHECK_NAMES = (
    "json_schema_valid",
    "messages_shape_valid",
    "has_thought_begin_token",
    "has_thought_end_token",
    "thought_tags_properly_paired",
    "has_solution_begin_token",
    "has_solution_end_token",
    "solution_tags_properly_paired",
    "tags_in_correct_order",
    "thought_tags_properly_nested",
    "solution_tags_properly_nested",
    "final_answer_boxed_if_required",
)
REPORT_DDL = (
    "input_item_id STRING, chunk_id STRING, passed BOOLEAN, errors ARRAY<STRING>, checks STRUCT<"
    + ", ".join(f"{name}: BOOLEAN" for name in CHECK_NAMES)
    + ">, created_at STRING"
)
REJECTED_DDL = f"item STRUCT<{ITEM_DDL}>, verify_report STRUCT<{REPORT_DDL}>"
ROLES = ("system", "user", "assistant")
SOURCE_FORMATS = ("markdown",)
METADATA_DEFAULTS = {"source": "synthetic", "difficulty": "medium", "subject": "general", "tags": []}
ITEM_METADATA_FIELDS = (
    "source", "difficulty", "subject", "tags", "project", "file_path", "file_name", "chunk_index", "chunk_id",
)
