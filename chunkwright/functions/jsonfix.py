"""Recover JSON from model replies, as column expressions.

The parsed value is a VARIANT, so presence, null and type of every field survive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkwright.functions.text import SPACE, let, strip

# The code fences, and what may follow a backslash in a JSON string.
FENCE = "```"
JSON_FENCE = "```json"
_ESCAPE = r'["\\/bfnrt]|u[0-9a-fA-F]{4}'
# What stands behind the text in the array that `parse_strict` makes of it.  It starts with a rare character,
# at which searches for it hardly ever stop.
_MARK = "~end-of-text"


def extract_fenced(reply: Column) -> Column:
    """Text of the first ``json`` fence, else of the first fence, else the reply; stripped."""

    def inside(text: Column, opening: str) -> Column:
        after = text.substr(F.instr(text, opening) + len(opening), F.length(text))
        return strip(F.substring_index(after, FENCE, 1))

    def fenced(text: Column) -> Column:
        return F.when(F.contains(text, F.lit(JSON_FENCE)), inside(text, JSON_FENCE)).otherwise(inside(text, FENCE))

    # A reply without a fence is looked through once.
    return F.when(F.contains(reply, F.lit(FENCE)), let(strip(reply), fenced)).otherwise(strip(reply))


def repair_escapes(text: Column) -> Column:
    """Double every backslash that does not start a valid JSON escape.

    Valid escapes are pairs from left to right, so of a run of backslashes only the last may start none, and
    that only where their number is odd.  Only such runs match, and each gets one backslash more.
    """
    odd_run = rf"\\(?<!\\\\)(?:\\\\)*+(?!{_ESCAPE})"
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, odd_run, r"$0\\")).otherwise(text)


def drop_trailing_commas(text: Column) -> Column:
    """Remove a comma that stands before a closing brace or bracket."""
    return F.regexp_replace(text, rf",(?={SPACE}*+[}}\]])", "")


def parse_strict(text: Column) -> Column:
    """The one JSON value that makes up the whole text as VARIANT, else NULL.

    The parser ignores what follows a complete value.  In an array with a mark behind it, only a text that is
    exactly one value leaves the mark in second place.  A text that could hold the mark itself is parsed
    twice instead, wrapped once in brackets and once in braces.
    """

    def marked(text: Column) -> Column:
        listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_MARK}"]')))
        return let(
            listed,
            lambda v: F.when(F.try_variant_get(v, "$[1]", "string") == _MARK, F.try_variant_get(v, "$[0]", "variant")),
        )

    def wrapped(text: Column) -> Column:
        listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
        named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
        return F.when(named.isNotNull(), F.try_variant_get(listed, "$[0]", "variant"))

    def parsed(text: Column) -> Column:
        # A string may spell letters as \u escapes.
        unsure = F.contains(text, F.lit(_MARK)) | F.contains(text, F.lit("\\u"))
        return F.when(unsure, wrapped(text)).otherwise(marked(text))

    return let(text, parsed)


def parse_reply(reply: Column, sanitize: bool = True, extract: bool = True) -> Column:
    """``STRUCT<value VARIANT, stage INT>``; NULL when nothing parses.

    Stages in order: 1 as it is, 2 escapes repaired, 3 commas dropped, 4 both.
    A later stage runs only where the ones before failed and its text differs from theirs.  Text with an escape
    to repair cannot parse with its commas dropped alone: what does not parse costs several times what does.
    """

    def attempt(candidate: Column, stage: int) -> Column:
        return let(
            parse_strict(candidate),
            lambda v: F.when(v.isNotNull(), F.struct(v.alias("value"), F.lit(stage).alias("stage"))),
        )

    def trimmed(text: Column, stage: int) -> Column:
        return let(drop_trailing_commas(text), lambda t: F.when(t != text, attempt(t, stage)))

    def repaired(text: Column) -> Column:
        if not sanitize:
            return trimmed(text, 3)
        return let(
            repair_escapes(text),
            lambda escaped: F.when(escaped == text, trimmed(text, 3)).otherwise(
                F.coalesce(attempt(escaped, 2), trimmed(escaped, 4))
            ),
        )

    def ladder(text: Column) -> Column:
        return F.when(text != "", F.coalesce(attempt(text, 1), repaired(text)))

    return let(extract_fenced(reply) if extract else reply, ladder)


def json_problem(text: Column) -> Column:
    """NULL for valid JSON, else a coarse reason: ``EMPTY`` or ``INVALID``."""
    return F.when(F.length(strip(F.coalesce(text, F.lit("")))) == 0, "EMPTY").when(
        parse_strict(text).isNull(), "INVALID"
    )
