"""Prompt templates compiled to column expressions.

Only ``{{ name }}`` and ``{{ a.b }}`` substitutions are supported.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_SLOT = re.compile(r"\{\{\s*([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*)\s*\}\}")
_MARKUP = re.compile(r"\{\{|\{%|\{#|\}\}|%\}")


def compile_template(template: str, values: Mapping[str, Column | str | int]) -> Column:
    """One string column: the template text with its slots filled.

    A slot that ``values`` does not name, or whose value is NULL, becomes empty.  One
    newline at the very end of the template is dropped.
    """
    if template.endswith("\n"):
        template = template[:-1]
    parts: list[Column] = []
    for n, piece in enumerate(_SLOT.split(template)):
        if n % 2:
            value = values.get(piece, "")
            value = value if isinstance(value, Column) else F.lit(value)
            parts.append(F.coalesce(value.cast("string"), F.lit("")))
        else:
            if _MARKUP.search(piece):
                raise ValueError(f"unsupported template markup near {piece[:40]!r}")
            if piece:
                parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def load_prompt(path: str) -> str:
    """Text of a prompt file, stripped.  Prompt files are small and read on the driver."""
    with open(path, encoding="utf-8") as handle:
        return handle.read().strip()
