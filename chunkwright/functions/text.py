"""Text helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware strip removes, newline excluded.
# Written as a regex class body that Java and RE2 read alike.
BLANK_CHARS = (
    r"\t\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same characters and the newline, one by one.
WHITESPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
BLANK = f"[{BLANK_CHARS}]"
SPACE = rf"[\n{BLANK_CHARS}]"
# A character of a word.  The plain ranges come first, so most text never meets the long class.
WORD_CHAR = rf"[!-~\x{{a1}}-\x{{167f}}[^\n{BLANK_CHARS}]]"


def strip(col: Column) -> Column:
    """Remove leading and trailing Unicode whitespace; most texts end in none, and are passed over."""
    # The last byte of a blank is below "!" or beyond ASCII.
    last = F.substring(col.cast("binary"), -1, 1)
    blank_end = ~last.between(F.lit(b"!"), F.lit(b"\x7f"))
    return F.when(blank_end, F.btrim(col, F.lit(WHITESPACE))).otherwise(F.ltrim(col, F.lit(WHITESPACE)))


def is_blank(col: Column) -> Column:
    """True for an empty or whitespace-only string."""
    return F.ltrim(col, F.lit(WHITESPACE)) == ""


def universal_newlines(col: Column) -> Column:
    """``\\r\\n`` and ``\\r`` become ``\\n``, as when a text file is opened for reading."""
    return F.regexp_replace(col, r"\r\n?", "\n")


def let(value: Column, body) -> Column:
    """Bind ``value`` once inside a lambda so ``body`` may use it many times."""
    return F.transform(F.array(value), body).getItem(0)


def empty_array(element: str) -> Column:
    """An empty array of the given element type."""
    return F.array().cast(f"array<{element}>")
