"""Record rules compiled to one ``ARRAY<STRING>`` column of errors.

A rule set is a small tree of ``Rule`` objects.  It compiles against a typed row (a NULL
field counts as missing) or against a VARIANT, where a missing field, a null and a value
of the wrong type are told apart as in the JSON text.  The tree becomes one SQL
expression, which Spark parses in a single call.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NONE = "cast(array() AS array<string>)"
_variables = count()


@dataclass(frozen=True)
class Rule:
    """What one value must satisfy.  ``kind`` is string, integer, boolean, array, object or map."""

    kind: str
    name: str = ""
    required: bool = True
    pattern: str | None = None
    min_length: int | None = None
    minimum: int | None = None
    allowed: Sequence[str] | None = None
    min_items: int | None = None
    min_properties: int | None = None
    each: Rule | None = None
    fields: Sequence[Rule] = ()
    closed: bool = False


@dataclass(frozen=True)
class _Step:
    """A step of a path that is only known per row, as SQL."""

    sql: str


Path = tuple["str | _Step", ...]


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fresh(prefix: str) -> str:
    return f"{prefix}{next(_variables)}"


def _let(value: str, body: Callable[[str], str]) -> str:
    name = _fresh("v")
    return f"transform(array({value}), {name} -> {body(name)})[0]"


def _error(path: Path, message: str | _Step) -> str:
    """The SQL text of ``path: message``; a plain literal where nothing depends on the row."""
    steps: list[str | _Step] = []
    for n, step in enumerate(path or ("root",)):
        steps += ["."] * bool(n) + [step]
    pieces: list[str | _Step] = []
    for step in [*steps, ": ", message]:
        if isinstance(step, str) and pieces and isinstance(pieces[-1], str):
            pieces[-1] += step
        else:
            pieces.append(step)
    sql = [_quote(p) if isinstance(p, str) else p.sql for p in pieces]
    return sql[0] if len(sql) == 1 else f"concat({', '.join(sql)})"


def _plain_tests(rule: Rule, value: str) -> list[tuple[str, str]]:
    """``(condition that must hold, message)`` for everything but nested values."""
    tests = []
    if rule.min_length is not None:
        # To count the characters of a text is not needed to see that it has one.
        enough = f"{value} <> ''" if rule.min_length == 1 else f"length({value}) >= {rule.min_length}"
        tests.append((enough, f"shorter than {rule.min_length}"))
    if rule.pattern is not None:
        tests.append((f"{value} RLIKE {_quote(rule.pattern)}", f"does not match {rule.pattern}"))
    if rule.allowed is not None:
        # Inside a lambda, where expressions are interpreted, IN ends its search by an exception.
        known = " OR ".join(f"{value} = {_quote(a)}" for a in rule.allowed)
        tests.append((f"({known})", f"not one of {', '.join(rule.allowed)}"))
    if rule.minimum is not None:
        tests.append((f"{value} >= {rule.minimum}", f"less than the minimum of {rule.minimum}"))
    if rule.min_items is not None:
        tests.append((f"size({value}) >= {rule.min_items}", f"fewer than {rule.min_items} items"))
    if rule.min_properties is not None:
        tests.append((f"size({value}) >= {rule.min_properties}", f"fewer than {rule.min_properties} properties"))
    return tests


def _plain_errors(rule: Rule, value: str, path: Path) -> list[str]:
    tests = [f"CASE WHEN NOT ({good}) THEN {_error(path, why)} END" for good, why in _plain_tests(rule, value)]
    return [f"filter(array({', '.join(tests)}), e -> e IS NOT NULL)"] if tests else []


def _concat(parts: Sequence[str]) -> str:
    return f"concat({', '.join(parts)})" if parts else _NONE


def _missing(rule: Rule, path: Path) -> str:
    return f"array({_error(path, f'{rule.name} is a required property')})"


def _wrong_type(rule: Rule, path: Path) -> str:
    return f"array({_error(path, 'not of type ' + ('object' if rule.kind == 'map' else rule.kind))})"


# --- typed records ---------------------------------------------------------------


def _typed(rule: Rule, value: str, dtype: T.DataType, path: Path) -> str:
    if rule.kind == "object":
        return _let(value, lambda v: _typed_fields(rule, f"{v}.", dtype, path))
    parts = _plain_errors(rule, value, path)
    if rule.kind == "array" and rule.each:
        v, i = _fresh("v"), _fresh("i")
        where = (*path, _Step(f"cast({i} AS string)"))
        inner = _typed(rule.each, v, dtype.elementType, where)
        null = _wrong_type(rule.each, where)
        parts.append(f"flatten(transform({value}, ({v}, {i}) -> CASE WHEN {v} IS NULL THEN {null} ELSE {inner} END))")
    if rule.kind == "map" and rule.each:
        e = _fresh("e")
        inner = _typed(rule.each, f"{e}.value", dtype.valueType, (*path, _Step(f"{e}.key")))
        parts.append(f"flatten(transform(map_entries({value}), {e} -> {inner}))")
    return _concat(parts)


def _typed_fields(rule: Rule, prefix: str, dtype: T.StructType, path: Path) -> str:
    known = {f.name: f.dataType for f in dtype.fields}
    parts = []
    for child in rule.fields:
        absent = _missing(child, path) if child.required else _NONE
        if child.name in known:
            value = f"{prefix}`{child.name}`"
            present = _typed(child, value, known[child.name], (*path, child.name))
            parts.append(f"CASE WHEN {value} IS NULL THEN {absent} ELSE {present} END")
        elif child.required:
            parts.append(absent)
    if rule.closed:
        for name in known.keys() - {r.name for r in rule.fields}:
            extra = _error(path, f"{name} is unexpected")
            parts.append(f"CASE WHEN {prefix}`{name}` IS NOT NULL THEN array({extra}) ELSE {_NONE} END")
    return _concat(parts)


def typed_errors(rule: Rule, schema: T.StructType) -> Column:
    """Errors of the record that the row's own columns form."""
    return F.expr(_typed_fields(rule, "", schema, ()))


def _holds(rule: Rule, value: str, dtype: T.DataType) -> str:
    tests = [good for good, _ in _plain_tests(rule, value)]
    v = _fresh("v")
    if rule.kind == "array" and rule.each:
        tests.append(f"forall({value}, {v} -> {v} IS NOT NULL AND {_holds(rule.each, v, dtype.elementType)})")
    if rule.kind == "map" and rule.each:
        tests.append(f"forall(map_values({value}), {v} -> {_holds(rule.each, v, dtype.valueType)})")
    if rule.kind == "object":
        tests.append(_fields_hold(rule, f"{value}.", dtype))
    return " AND ".join(f"({t})" for t in tests) or "true"


def _fields_hold(rule: Rule, prefix: str, dtype: T.StructType) -> str:
    known = {f.name: f.dataType for f in dtype.fields}
    tests = []
    for child in rule.fields:
        if child.name in known:
            value = f"{prefix}`{child.name}`"
            good = f"coalesce({_holds(child, value, known[child.name])}, false)"
            tests.append(f"{value} IS NOT NULL AND {good}" if child.required else f"{value} IS NULL OR {good}")
        elif child.required:
            tests.append("false")
    if rule.closed:
        tests += [f"{prefix}`{name}` IS NULL" for name in known.keys() - {r.name for r in rule.fields}]
    return " AND ".join(f"({t})" for t in tests) or "true"


def typed_valid(rule: Rule, schema: T.StructType) -> Column:
    """Whether the row's own columns form a record without errors.

    The same answer as an empty ``typed_errors``, as one plain predicate.
    """
    return F.expr(_fields_hold(rule, "", schema))


# --- VARIANT records -------------------------------------------------------------


def _variant(rule: Rule, value: str, path: Path) -> str:
    wrong = _wrong_type(rule, path)

    def read(as_type: str, good: Callable[[str], str]) -> str:
        """Errors of the value as another type; it is NULL when the kinds do not agree."""
        return _let(
            f"try_variant_get({value}, '$', '{as_type}')", lambda v: f"CASE WHEN {v} IS NULL THEN {wrong} ELSE {good(v)} END"
        )

    if rule.kind == "array":
        return read("array<variant>", lambda a: _variant_array(rule, a, path))
    if rule.kind == "map":
        return read("map<string,variant>", lambda m: _variant_map(rule, m, path))
    if rule.kind == "object":
        return read("map<string,variant>", lambda m: _variant_object(rule, m, path))
    if rule.kind == "integer":
        # A whole number is an integer, however it is written.
        number = f"try_variant_get({value}, '$', 'double')"
        whole = _let(
            f"schema_of_variant({value})",
            lambda k: f"{k} = 'BIGINT' OR (({k} = 'DOUBLE' OR {k} LIKE 'DECIMAL%') AND {number} = floor({number}))",
        )
        good = read("decimal(38,0)", lambda n: _concat(_plain_errors(rule, n, path)))
        return f"CASE WHEN {whole} THEN {good} ELSE {wrong} END"
    good = read("string", lambda s: _concat(_plain_errors(rule, s, path)))
    return f"CASE WHEN schema_of_variant({value}) = '{rule.kind.upper()}' THEN {good} ELSE {wrong} END"


def _variant_array(rule: Rule, items: str, path: Path) -> str:
    parts = _plain_errors(rule, items, path)
    if rule.each:
        v, i = _fresh("v"), _fresh("i")
        inner = _variant(rule.each, v, (*path, _Step(f"cast({i} AS string)")))
        parts.append(f"flatten(transform({items}, ({v}, {i}) -> {inner}))")
    return _concat(parts)


def _variant_map(rule: Rule, entries: str, path: Path) -> str:
    parts = _plain_errors(rule, entries, path)
    if rule.each:
        e = _fresh("e")
        inner = _variant(rule.each, f"{e}.value", (*path, _Step(f"{e}.key")))
        parts.append(f"flatten(transform(map_entries({entries}), {e} -> {inner}))")
    return _concat(parts)


def _variant_object(rule: Rule, entries: str, path: Path) -> str:
    def field(child: Rule) -> str:
        absent = _missing(child, path) if child.required else _NONE
        return _let(
            f"try_element_at({entries}, {_quote(child.name)})",
            lambda v: f"CASE WHEN {v} IS NULL THEN {absent} ELSE {_variant(child, v, (*path, child.name))} END",
        )

    parts = [field(child) for child in rule.fields]
    if rule.closed:
        k = _fresh("k")
        declared = ", ".join(_quote(r.name) for r in rule.fields)
        extra = f"array_sort(array_except(map_keys({entries}), array({declared})))"
        parts.append(f"transform({extra}, {k} -> {_error(path, _Step(f'''concat({k}, ' is unexpected')'''))})")
    return _concat(parts)


def variant_errors(rule: Rule, record: str) -> Column:
    """Errors of a record held as VARIANT; ``record`` is its column or SQL expression."""
    return F.expr(_variant(rule, record, ()))
