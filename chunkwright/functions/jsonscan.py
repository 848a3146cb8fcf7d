"""Where a text stops being JSON, as a column expression.

One regex cuts the text into tokens, so strings and numbers are judged whole; a fold over the tokens with
a stack of open brackets finds the first one that may not stand where it does.  Only a string that is not
closed or holds a fault is looked into, once.  Work is linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkwright.functions.text import let

# The messages, as common JSON readers word them.
VALUE = "Expecting value"
NAME = "Expecting property name enclosed in double quotes"
COLON = "Expecting ':' delimiter"
COMMA = "Expecting ',' delimiter"
EXTRA = "Extra data"
LAST_IN_OBJECT = "Illegal trailing comma before end of object"
LAST_IN_ARRAY = "Illegal trailing comma before end of array"
OPEN_STRING = "Unterminated string starting at"
CONTROL = "Invalid control character at"
ESCAPE = "Invalid \\escape"
UNICODE_ESCAPE = "Invalid \\uXXXX escape"
BYTE_ORDER_MARK = "Unexpected UTF-8 BOM (decode using utf-8-sig)"

# Marks a faulty string until it is looked into.
STRING = "string"
_IN_STRING = r'(?:[^"\\\x00-\x1f]++|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*+'
# Readers want a character after the digits of an escape.
_SOUND = _IN_STRING.replace("{4})", r"{4}(?!\z))")
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][-+]?[0-9]++)?"
# Tokens from the begin on, as far as each can stand in JSON at all.
_TOKEN = rf'\G(?:[ \t\n\r]++|"{_IN_STRING}"|{_NUMBER}|true|false|null|[{{}}\[\],:])'

# What may come next: a value; a value or the end of an array; a name or the end of an object; a name; a colon;
# a comma or the end of what is open; nothing; a value after a comma.
_STATES = dict(value=0, first=1, name_or_end=2, name=3, colon=4, comma=5, end=6, next=7)


def _kind(token: Column) -> Column:
    """A bracket, comma or colon itself, else w (white space), s (string), q (faulty string), v (other value) or x."""
    first = F.substring(token, 1, 1)
    return (
        F.when(first.isin(" ", "\t", "\n", "\r"), "w")
        .when(token.isin("{", "}", "[", "]", ",", ":"), token)
        .when(first == '"', F.when(F.length(token) > 1, "s").otherwise("q"))
        .when((F.length(token) > 1) | token.between("0", "9"), "v")
        .otherwise("x")
    )


def _step(m: Column, t: Column, k: Column) -> Column:
    """The state after a token of a kind."""
    s = _STATES
    value, name = m["state"].isin(s["value"], s["first"], s["next"]), m["state"].isin(s["name_or_end"], s["name"])

    def go(state: Column | int, stack: Column | None = None, comma: Column | None = None) -> Column:
        state = F.lit(state) if isinstance(state, int) else state
        return F.struct(
            (m["at"] + F.length(t)).alias("at"), state.alias("state"), (m["stack"] if stack is None else stack).alias("stack"),
            (m["comma"] if comma is None else comma).alias("comma"), m["why"].alias("why"),
        )

    def stop(why: str, at: Column | None = None) -> Column:
        return F.struct(
            (m["at"] if at is None else at).alias("at"), m["state"].alias("state"), m["stack"].alias("stack"), m["comma"].alias("comma"), F.lit(why).alias("why")
        )

    popped = m["stack"].substr(F.lit(2), F.length(m["stack"]))
    # After a value: within brackets a comma or their end, else nothing.
    after = lambda stack: F.when(F.length(stack) > 0, s["comma"]).otherwise(s["end"])
    top = F.substring(m["stack"], 1, 1)
    open_object, open_array = m["state"] == s["name_or_end"], m["state"] == s["first"]
    return (
        F.when(k == "w", go(m["state"]))
        .when(value & k.isin("s", "v"), go(after(m["stack"])))
        .when(value & (k == "{"), go(s["name_or_end"], F.concat(k, m["stack"])))
        .when(value & (k == "["), go(s["first"], F.concat(k, m["stack"])))
        .when(open_array & (k == "]") | open_object & (k == "}"), go(after(popped), popped))
        .when((m["state"] == s["next"]) & (k == "]"), stop(LAST_IN_ARRAY, m["comma"]))
        .when((m["state"] == s["name"]) & (k == "}"), stop(LAST_IN_OBJECT, m["comma"]))
        .when(name & (k == "s"), go(s["colon"]))
        .when((m["state"] == s["colon"]) & (k == ":"), go(s["value"]))
        .when((m["state"] == s["comma"]) & (k == ","), go(F.when(top == "[", s["next"]).otherwise(s["name"]), comma=m["at"]))
        .when((m["state"] == s["comma"]) & ((top == "[") & (k == "]") | (top == "{") & (k == "}")), go(after(popped), popped))
        .when((value | name) & (k == "q"), stop(STRING))
        .when(value, stop(VALUE))
        .when(name, stop(NAME))
        .when(m["state"] == s["colon"], stop(COLON))
        .when(m["state"] == s["comma"], stop(COMMA))
        .otherwise(stop(EXTRA))
    )


def _first_fault(tokens: Column) -> Column:
    """``STRUCT<at, why>`` of the first token that may not stand where it does, or of the end; ``why`` is NULL for valid JSON."""
    s = _STATES
    none = F.lit(None).cast("string")
    begin = F.struct(F.lit(0).alias("at"), F.lit(s["value"]).alias("state"), F.lit("").alias("stack"), F.lit(0).alias("comma"), none.alias("why"))

    def end(m: Column) -> Column:
        missing = (
            F.when(m["state"] == s["end"], none)
            .when(m["state"].isin(s["name_or_end"], s["name"]), NAME)
            .when(m["state"] == s["colon"], COLON)
            .when(m["state"] == s["comma"], COMMA)
            .otherwise(VALUE)
        )
        return F.struct(m["at"].alias("at"), F.coalesce(m["why"], missing).alias("why"))

    return F.aggregate(tokens, begin, lambda m, t: F.when(m["why"].isNotNull(), m).otherwise(let(_kind(t), lambda k: _step(m, t, k))), end)


def _string_fault(text: Column, at: Column) -> Column:
    """What is wrong with the string that begins at ``at``, and where."""
    sound = F.length(F.regexp_extract(text.substr(at + 1, F.length(text)), f'^"{_SOUND}', 0))
    after = let(F.struct((at + sound).alias("at"), F.substr(text, at + sound + 1, F.lit(2)).alias("two")), lambda x: (
        F.when((x["two"] == "") | (x["two"] == "\\"), F.struct(at.alias("at"), F.lit(OPEN_STRING).alias("why")))
        .when(~F.startswith(x["two"], F.lit("\\")), F.struct(x["at"].alias("at"), F.lit(CONTROL).alias("why")))
        .when(x["two"] == "\\u", F.struct((x["at"] + 1).alias("at"), F.lit(UNICODE_ESCAPE).alias("why")))
        .otherwise(F.struct(x["at"].alias("at"), F.lit(ESCAPE).alias("why")))
    ))
    return after


def json_fault(text: Column) -> Column:
    """NULL for valid JSON, else ``STRUCT<message, line, column>`` of the first fault; a NULL text counts as empty.

    Lines and columns count from 1, columns in characters.  ``NaN`` and ``Infinity`` are faults.
    """

    def located(source: Column, found: Column) -> Column:
        exact = F.when(found["why"] == STRING, _string_fault(source, found["at"])).otherwise(found)
        return let(exact, lambda e: F.when(e["why"].isNotNull(), place(source, e)))

    def place(source: Column, e: Column) -> Column:
        before = source.substr(F.lit(1), e["at"])
        return let(before, lambda b: F.struct(
            e["why"].alias("message"),
            (F.length(b) - F.length(F.replace(b, F.lit("\n"), F.lit(""))) + 1).alias("line"),
            (F.length(F.substring_index(b, "\n", -1)) + 1).alias("column"),
        ))

    def scanned(source: Column) -> Column:
        tokens = let(F.regexp_extract_all(source, F.lit(_TOKEN), F.lit(0)), lambda sound: let(
            # The character that no token begins with is a fault wherever it stands; a quote begins a faulty string.
            source.substr(F.length(F.array_join(sound, "")) + 1, F.lit(1)),
            lambda odd: F.when(odd == "", sound).otherwise(F.concat(sound, F.array(odd))),
        ))
        mark = F.struct(F.lit(0).alias("at"), F.lit(BYTE_ORDER_MARK).alias("why"))
        return F.when(F.startswith(source, F.lit("\ufeff")), located(source, mark)).otherwise(
            let(_first_fault(tokens), lambda found: located(source, found))
        )

    return let(F.coalesce(text, F.lit("")), scanned)
