"""From reply texts to item records, and the replies that failed on the way."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright import schemas
from chunkwright.functions.ids import stable_uuid
from chunkwright.functions.jsonfix import extract_fenced, json_problem, parse_reply, repair_escapes
from chunkwright.functions.text import is_blank, let
from chunkwright.operators.prompts import GENERATION_SYSTEM
from chunkwright.session import once, unpacked


def parse_replies(replies: DataFrame) -> DataFrame:
    """Add the parse ``stage``, the reply's ``elements`` and a ``failure`` reason or NULL.

    ``replies`` has ``content`` and whatever columns identify the chunk.  A value that is
    no array counts as an array of one.  One element that is no object fails the reply.
    """

    def stage_and_elements(parsed: Column) -> Column:
        value = parsed["value"]
        elements = F.coalesce(
            F.try_variant_get(value, "$", "array<variant>"), F.when(value.isNotNull(), F.array(value))
        )
        return F.struct(parsed["stage"].alias("stage"), elements.alias("elements"))

    listed = unpacked(replies.select("*", let(parse_reply(F.col("content")), stage_and_elements).alias("_parsed")), "_parsed")
    # The name of a value's type is found without a copy of what it holds.
    no_object = F.exists("elements", lambda e: ~F.coalesce(F.startswith(F.schema_of_variant(e), F.lit("OBJECT")), F.lit(False)))
    return listed.withColumn(
        "failure",
        F.when(F.col("content").isNull() | is_blank(F.col("content")), "empty reply")
        .when(F.col("stage").isNull(), "no JSON")
        .when(no_object, "element is no object"),
    )


def reply_elements(parsed: DataFrame) -> DataFrame:
    """One row per element that has both keys, with its position in the reply.

    A key whose value is null is present.  ``problem`` and ``solution`` are texts; a value
    of another type stays visible through ``problem_is_text`` and ``solution_is_text``.
    """
    keep = [c for c in parsed.columns if c not in ("content", "stage", "elements", "failure")]
    exploded = parsed.where(F.col("failure").isNull()).select(
        *keep, F.posexplode_outer("elements").alias("position", "_e")
    )
    names = ("problem", "solution")
    texts = {n: F.try_variant_get("_e", f"$.{n}", "string") for n in names}
    # A key that is absent has no type; that of a null is VOID.
    types = {f"_{n}_type": F.schema_of_variant(F.try_variant_get("_e", f"$.{n}", "variant")) for n in names}
    found = once(exploded, {**texts, **types}).where(" AND ".join(f"{t} IS NOT NULL" for t in types))
    kinds = [(F.col(f"_{n}_type") == "STRING").alias(f"{n}_is_text") for n in names]
    return found.select(*keep, "position", *names, *kinds)


def build_items(
    elements: DataFrame,
    created_at: Column | str,
    system_prompt: str = GENERATION_SYSTEM,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Item records of reply elements.

    ``elements`` carries the chunk columns ``chunk_id, project, file_path, file_name,
    chunk_index``, which go over the metadata defaults.  A problem or solution that was
    no text becomes NULL, which the item rules report.
    """
    base = {**schemas.METADATA_DEFAULTS, **(defaults or {})}
    tags = F.array(*[F.lit(t) for t in base["tags"]]).cast("array<string>")
    text = {name: F.when(F.col(f"{name}_is_text"), F.col(name)) for name in ("problem", "solution")}
    stamp = created_at if isinstance(created_at, Column) else F.lit(created_at)
    metadata = F.struct(
        *[F.lit(base[k]).alias(k) for k in ("source", "difficulty", "subject")],
        tags.alias("tags"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("project", "file_path", "file_name")],
        F.coalesce("chunk_index", F.lit(0)).alias("chunk_index"),
        F.coalesce("chunk_id", F.lit("")).alias("chunk_id"),
    )
    return elements.select(
        stable_uuid(F.col("chunk_id"), F.col("position")).alias("id"),
        F.lit(system_prompt).alias("system_prompt"),
        metadata.alias("metadata"),
        F.array(
            F.struct(F.lit("user").alias("role"), text["problem"].alias("content")),
            F.struct(F.lit("assistant").alias("role"), text["solution"].alias("content")),
        ).alias("messages"),
        text["problem"].alias("problem"),
        text["solution"].alias("solution"),
        stamp.alias("created_at"),
    )


def failed_replies(parsed: DataFrame) -> DataFrame:
    """Replies that gave no items, with every form of the text that was tried."""
    keep = [c for c in parsed.columns if c not in ("content", "stage", "elements", "failure")]
    body = extract_fenced(F.col("content"))
    return parsed.where(F.col("failure").isNotNull()).select(
        *keep,
        "failure",
        F.col("content").alias("raw"),
        body.alias("extracted"),
        repair_escapes(body).alias("sanitized"),
        F.coalesce(json_problem(body), F.lit("VALID")).alias("json"),
        F.length("content").alias("content_length"),
    )


def stage_stats(parsed: DataFrame) -> DataFrame:
    """How many replies parsed at each stage; stage 0 for those that did not."""
    return parsed.groupBy(F.coalesce("stage", F.lit(0)).alias("stage")).agg(F.count("*").alias("replies"))
