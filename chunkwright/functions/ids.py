"""Hashes and identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The identifier formats.
SHA256_PREFIX = "sha256:"
CHUNK_ID_PATTERN = "^sha256:[a-f0-9]{64}$"
SHA1_PATTERN = "^[a-f0-9]{40}$"
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
RUN_ID_PATTERN = "^run_[0-9]{8}_[0-9]{6}$"


def sha256_hash(col: Column) -> Column:
    """``sha256:`` and the hex digest of the UTF-8 text."""
    return F.concat(F.lit(SHA256_PREFIX), F.sha2(col, 256))


def sha1_hash(col: Column) -> Column:
    """Hex SHA-1 of a binary column, or of the UTF-8 bytes of a string column."""
    return F.sha1(col)


def chunk_id(project: Column, file_path: Column, index: Column, file_sha1: Column) -> Column:
    """Stable chunk id from where the chunk stands and what its file holds."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (project, file_path, index, file_sha1)]
    return sha256_hash(F.concat_ws("|", *parts))


def stable_uuid(*parts: Column) -> Column:
    """A version-4-shaped UUID drawn from a hash of the parts.

    A random id would change when Spark recomputes a lost partition; this one does not.
    """
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    hexed = F.sha2(text, 256)
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(hexed, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat(
        F.substring(hexed, 1, 8), F.lit("-"), F.substring(hexed, 9, 4), F.lit("-4"),
        F.substring(hexed, 14, 3), F.lit("-"), variant, F.substring(hexed, 18, 3),
        F.lit("-"), F.substring(hexed, 21, 12),
    )


def run_id(ts: Column) -> Column:
    """``run_YYYYMMDD_HHMMSS`` in the session time zone; run sessions in UTC."""
    return F.date_format(ts, "'run_'yyyyMMdd_HHmmss")


def is_valid_uuid(col: Column) -> Column:
    return F.coalesce(col.rlike(UUID_PATTERN), F.lit(False))


def is_valid_run_id(col: Column) -> Column:
    return F.coalesce(col.rlike(RUN_ID_PATTERN), F.lit(False))
