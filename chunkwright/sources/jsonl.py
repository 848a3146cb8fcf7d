"""JSON-lines tables."""

from __future__ import annotations

import os
import re
from functools import reduce
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkwright.functions.jsonfix import parse_strict
from chunkwright.functions.text import is_blank
from chunkwright.schemas import CHUNK_DDL
from chunkwright.operators.validation import validate_json
from chunkwright.session import durable, once
from chunkwright.sources.listing import HIDDEN, PACKED, file_system, list_files, read_ranges

# Characters that stand for themselves in the path of a URI.
_IN_URI = "/_-!.~'()*,;:$&+=@"


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Typed rows of JSON lines; blank lines are skipped.

    A line is malformed if it is not one JSON value of this schema; Spark's own reader overlooks what
    follows the value.  With ``strict`` the first malformed line fails the job.  Without, malformed lines
    keep their text in ``_corrupt_record``.
    """
    lines, whole = read_lines(spark, path), parse_strict(F.col("value")).isNotNull()
    if strict:
        record = F.from_json("value", schema, {"mode": "FAILFAST"})
        why = F.raise_error(F.concat(F.lit("malformed line in "), "file"))
        return lines.select(F.when(whole, record).otherwise(why).alias("_r")).select("_r.*")
    record = F.from_json("value", f"{schema}, _corrupt_record STRING", {"mode": "PERMISSIVE"})
    read = once(lines, {"_r": record, "_whole": whole}).withColumn("_bad", F.when(~F.col("_whole"), F.col("value")))
    fields = [F.col("_r").getField(f).alias(f) for f in read.schema["_r"].dataType.names if f != "_corrupt_record"]
    return read.select(*fields, F.coalesce("_r._corrupt_record", "_bad").alias("_corrupt_record"))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row in UTF-8; null fields keep their keys."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunk lines in one folder per project."""
    (
        chunks.withColumn("in_project", F.col("project"))
        .write.mode("overwrite")
        .partitionBy("in_project")
        .json(path)
    )


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """All chunks below a folder, in one scan."""
    return read_jsonl(spark, path, CHUNK_DDL)


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Non-blank lines as ``(file, value)``.

    Files of a mounted folder are listed and read by tasks, so that many small ones cost neither the driver a list
    of them nor a reader each.  Spark reads what else there is: other stores, patterns, single and compressed files.
    """
    parts = ((_lines_by_tasks(spark, path), path) for path in paths)
    lines = [_lines_by_spark(spark, path) if made is None else made for made, path in parts]
    return reduce(DataFrame.unionByName, lines).where(~is_blank(F.col("value")))


def _lines_by_spark(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), "value")


def _lines_by_tasks(spark: SparkSession, path: str) -> DataFrame | None:
    """Lines ``(file, value)`` of a mounted folder, or None where Spark's reader is needed."""
    if re.search(r"[*?{}\[\]\\]", path) or "://" in path and not path.startswith("file:"):
        return None
    store, root = file_system(path)
    root = os.path.abspath(root)
    if store.get_file_info(root).type != fs.FileType.Directory:
        return None
    files = durable(list_files(spark, root).where(~F.col("relpath").rlike(HIDDEN)), "line-files")
    if not files.where(F.col("relpath").rlike(PACKED)).isEmpty():
        return None
    # As a URI, like Spark's own names of files.
    above = "".join(c if c > "\x7f" else quote(c, safe=_IN_URI) for c in root)
    name = F.concat(F.lit(f"file:{above}/"), _uri(F.col("relpath")))
    return read_ranges(files, root).select(name.alias("file"), "value")


def _uri(path: Column) -> Column:
    """A path as in a URI: ASCII characters that may not stand there become percent codes."""
    odd = {c: quote(c) for c in map(chr, range(128)) if quote(c, safe=_IN_URI) != c}
    coded = reduce(lambda p, c: F.replace(p, F.lit(c), F.lit(odd[c])), ["%", *sorted(set(odd) - {"%"})], path)
    return F.when(path.rlike(r"[^\w/.\-=+,:;@~!$&'()*]"), coded).otherwise(path)


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines per file; files without any are absent."""
    return read_lines(spark, path).groupBy("file").agg(F.count("*").alias("lines"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines as ``(file, line, value)`` with the 1-based line number in the file.

    A big file is read in blocks.  Lines are numbered inside their block, whose size the
    scan bounds, and shifted by the lines of the blocks before it.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        "value",
    )
    per_block = lines.groupBy("file", "_block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_block.select("file", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("file", "_block").orderBy("_at")
    return (
        lines.withColumn("_row", F.row_number().over(inside))
        .join(shifts, ["file", "_block"])
        .where(~is_blank(F.col("value")))
        .select("file", (F.col("_shift") + F.col("_row")).alias("line"), "value")
    )


def read_verified(spark: SparkSession, path: str) -> DataFrame:
    """Lines of verified items below a folder as ``(file, value, id, errors, valid)``."""
    return checked_items(read_lines(spark, path))


def checked_items(lines: DataFrame) -> DataFrame:
    """Lines ``(file, value)`` with the item's ``id``, its ``errors`` and whether it is ``valid``.

    The line itself travels on, so fields the rules leave open are kept as they are.  A bad
    line is flagged and costs no other line of its file.
    """
    checked = validate_json(lines, "item")
    return checked.select("file", "value", F.get_json_object("value", "$.id").alias("id"), "errors", "valid")
