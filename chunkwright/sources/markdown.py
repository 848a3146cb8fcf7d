"""Markdown folders as document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.functions.ids import sha1_hash
from chunkwright.functions.text import universal_newlines
from chunkwright.sources.listing import list_files, read_files


def find_files(spark: SparkSession, root: str, pattern: str = "*.md") -> DataFrame:
    """Files at any depth below ``root`` as ``(path, length, content, relpath)``; sort by path where order matters."""
    files = read_files(list_files(spark, root, pattern).select("relpath", "length"), root)
    return files.select(F.concat(F.lit(root.rstrip("/") + "/"), "relpath").alias("path"), "length", "content", "relpath")


def read_markdown(spark: SparkSession, root: str, strict: bool = True) -> DataFrame:
    """Documents below ``root/<project>/``: ``(project, file_path, file_name, text, file_sha1)``.

    The SHA-1 is of the raw bytes.  Text is UTF-8 with newlines unified; a byte order mark
    stays.  With ``strict`` a malformed file fails the job; without, its text is NULL, so
    that it can be set aside.  Folders that start with a dot are no projects.
    """
    files = find_files(spark, root)
    raw = F.col("content").cast("string")
    text = F.validate_utf8(raw) if strict else F.try_validate_utf8(raw)
    return (
        files.withColumn("project", F.regexp_extract("relpath", "^([^/]+)/", 1))
        .where((F.col("project") != "") & ~F.col("project").startswith("."))
        .select(
            "project",
            F.regexp_extract("relpath", "^[^/]+/(.*)$", 1).alias("file_path"),
            F.regexp_extract("relpath", "([^/]*)$", 1).alias("file_name"),
            universal_newlines(text).alias("text"),
            sha1_hash(F.col("content")).alias("file_sha1"),
        )
    )


def discover_projects(spark: SparkSession, root: str) -> DataFrame:
    """Sorted names of the folders directly below ``root`` that hold markdown at any depth; no file is opened."""
    project = F.regexp_extract("relpath", "^([^/]+)/", 1)
    return (
        list_files(spark, root, "*.md")
        .select(project.alias("project"))
        .where((F.col("project") != "") & ~F.col("project").startswith("."))
        .distinct()
        .orderBy("project")
    )
