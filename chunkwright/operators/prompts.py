"""Message tables for generation and verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.functions.templates import compile_template

# The section tags a solution has to carry.
THOUGHT_BEGIN = "<|begin_of_thought|>"
THOUGHT_END = "<|end_of_thought|>"
SOLUTION_BEGIN = "<|begin_of_solution|>"
SOLUTION_END = "<|end_of_solution|>"

GENERATION_SYSTEM = (
    "You write question and answer pairs for supervised fine-tuning. Use only facts from the given "
    f"text. Wrap the reasoning in {THOUGHT_BEGIN} and {THOUGHT_END} and the answer in "
    f"{SOLUTION_BEGIN} and {SOLUTION_END}. Reply in strict JSON."
)
GENERATION_USER = (
    "Write {{ n }} question and answer pairs about the text below.\n"
    "Project {{ project }}, file {{ file_name }}, part {{ chunk_index }}, id {{ chunk_id }}.\n\n"
    "{{ chunk_text }}\n\n"
    'Reply with a JSON array of objects with the keys "problem" and "solution".'
)
VERIFICATION_SYSTEM = "You check question and answer pairs against their source text and reject every flawed one."
VERIFICATION_USER = (
    "Candidate:\n{{ candidate_json }}\n\n"
    "Source: project {{ chunk_meta.project }}, file {{ chunk_meta.file_name }}, "
    "part {{ chunk_meta.chunk_index }}, id {{ chunk_meta.chunk_id }}.\n\n"
    "{{ chunk_text }}\n\n"
    'Reply with a JSON object with the keys "passed" (true or false) and "errors" (array of texts).'
)


def messages(system: Column | str, user: Column) -> Column:
    """Two messages as ``ARRAY<STRUCT<role, content>>``."""
    system = system if isinstance(system, Column) else F.lit(system)
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def generation_requests(
    chunks: DataFrame,
    items_per_chunk: int = 2,
    system: str = GENERATION_SYSTEM,
    template: str = GENERATION_USER,
) -> DataFrame:
    """One request per chunk: ``(request_id, messages)``; the request id is the chunk id."""
    user = compile_template(
        template,
        {
            "n": items_per_chunk,
            "project": F.col("project"),
            "file_name": F.col("file_name"),
            "chunk_index": F.coalesce("chunk_index", F.lit(0)),
            "chunk_id": F.col("chunk_id"),
            "chunk_text": F.col("text"),
        },
    )
    return chunks.select(F.col("chunk_id").alias("request_id"), messages(system, user).alias("messages"))


def verification_requests(
    items: DataFrame,
    chunks: DataFrame,
    system: str = VERIFICATION_SYSTEM,
    template: str = VERIFICATION_USER,
) -> DataFrame:
    """One request per item, with the text of the chunk it came from."""
    source = chunks.select(
        "chunk_id",
        F.col("project").alias("_project"),
        F.col("file_name").alias("_file_name"),
        F.col("chunk_index").alias("_chunk_index"),
        F.col("text").alias("_text"),
    )
    fields = ["id", "system_prompt", "metadata", "messages", "problem", "solution", "created_at"]
    candidate = items.select(
        F.col("id").alias("request_id"),
        F.col("metadata.chunk_id").alias("chunk_id"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("_json"),
    )
    user = compile_template(
        template,
        {
            "candidate_json": F.col("_json"),
            "chunk_meta.project": F.col("_project"),
            "chunk_meta.file_name": F.col("_file_name"),
            "chunk_meta.chunk_index": F.coalesce("_chunk_index", F.lit(0)),
            "chunk_meta.chunk_id": F.col("chunk_id"),
            "chunk_text": F.col("_text"),
        },
    )
    return candidate.join(source, "chunk_id", "left").select("request_id", messages(system, user).alias("messages"))
