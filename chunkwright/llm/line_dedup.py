"""Removal of repeated lines through overlapping three-line windows.

Each window of three consecutive lines is hashed; a window that occurs more than once in the
corpus is repeated, and all its occurrences but the first (by ``doc_id``, then line number) are
later occurrences.  A line goes if a later occurrence covers it; overlapping occurrences merge.

Lines end at ``\\n`` and compare exactly.  Windows of blank lines only do not count.  Texts of
fewer than three lines, empty and null texts stay as they are.  Rows that share a ``doc_id``
are told apart by a hash of their text; of equal rows one, whichever it is, stands before the
others, which so hold nothing but later occurrences.  Null ``doc_id`` sorts first.  All other columns are ignored by ``line_decisions`` and
kept by ``remove_repeated_lines``.  An empty table gives an empty one; a very long text is one row of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.shared import wide_hash
from chunkwright.session import durable, once

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def window_rows(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text_hash, at, h1, h2`` of every window that counts, written once.

    A line's hash carries in its lowest bit whether the line is blank; a window's 128-bit hash
    is made of those of its lines.
    """
    line_hash = lambda line: F.xxhash64(line).bitwiseAND(F.lit(-2)).bitwiseOR((F.trim(line) == "").cast("bigint"))
    rows = once(
        documents.where(F.col("text").isNotNull()).select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
        ),
        {"hashes": F.transform(_lines(F.col("text")), line_hash)},
    )
    places = [F.slice("hashes", k + 1, F.greatest(F.size("hashes") - (window - 1), F.lit(0))) for k in range(window)]
    zipped = F.arrays_zip(*[p.alias(f"p{k}") for k, p in enumerate(places)])
    spread = rows.select("doc_id", "text_hash", F.posexplode(zipped).alias("at", "w"))
    lines = [F.col("w")[f"p{k}"] for k in range(window)]
    blank = lines[0]
    for line in lines[1:]:
        blank = blank.bitwiseAND(line)
    counted = spread.where(blank.bitwiseAND(F.lit(1)) == 0)
    return durable(counted.select("doc_id", "text_hash", "at", wide_hash(*lines).alias("h")).select("doc_id", "text_hash", "at", "h.*"), "line-windows")


def occurrences(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Window starts of repeated windows: ``doc_id, text_hash, at``, and whether the first occurrence is there.

    Equal rows come more than once.  Counting and finding the first occurrence combine before the
    shuffle, so a window that a third of all documents share is one row per task; the join back
    carries narrow rows.
    """
    rows = window_rows(documents, window)
    place = F.struct("doc_id", "text_hash", "at")
    repeated = (
        rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    )
    # Only occurrences of repeated windows are worth keeping, and only they are joined back.
    found = rows.join(repeated.drop("n"), ["h1", "h2"])
    return found.select("doc_id", "text_hash", "at", place.eqNullSafe(F.col("first")).alias("is_first"))


def covered_lines(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document with later occurrences, the sorted first lines of those windows.

    ``starts`` are those of the document, or of one of several equal rows; ``others``, null where
    no rows are equal, are those of the rest, in which every repeated window is a later occurrence.
    """
    found = occurrences(documents, window).groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("n"), F.collect_set("at").alias("all"), F.collect_set(F.when(F.col("is_first"), F.col("at"))).alias("firsts")
    )
    later = F.array_sort(F.array_except("all", "firsts"))
    # Every equal row brings each of its windows once.
    return found.select(
        "doc_id", "text_hash", F.when(F.size(later) > 0, later).alias("starts"),
        F.when(F.col("n") > F.size("all"), F.array_sort("all")).alias("others"),
    ).where("starts IS NOT NULL OR others IS NOT NULL")


def _tell_apart(joined: DataFrame) -> DataFrame:
    """The rows, of which all equal ones but one have the starts of the others."""
    equal = joined.where("_ld_others IS NOT NULL").withColumn("_ld_row", F.monotonically_increasing_id())
    equal = durable(equal, "equal-rows")
    first = equal.groupBy("_ld_id", "_ld_hash").agg(F.min("_ld_row").alias("_ld_row"))
    told = equal.join(first.select("_ld_row", F.lit(True).alias("_ld_first")), "_ld_row", "left").withColumn(
        "_ld_starts", F.when(F.col("_ld_first"), F.col("_ld_starts")).otherwise(F.col("_ld_others"))
    )
    return joined.where("_ld_others IS NULL").unionByName(told.select(*joined.columns))


def _decide(documents: DataFrame, window: int) -> DataFrame:
    """All columns, and the kept lines and the number of lines under names of this module.

    The texts meet their covered lines in a sort-merge join whatever the sizes: which documents
    change is known only there, and their list grows with the corpus.
    """
    covered = durable(covered_lines(documents, window), "covered-lines").select(
        F.col("doc_id").alias("_ld_id"), F.col("text_hash").alias("_ld_hash"),
        F.col("starts").alias("_ld_starts"), F.col("others").alias("_ld_others"),
    )
    joined = documents.withColumn("_ld_lines", _lines(F.col("text"))).join(
        covered.hint("merge"),
        F.col("doc_id").cast("bigint").eqNullSafe(F.col("_ld_id")) & (F.xxhash64("text") == F.col("_ld_hash")),
        "left",
    )
    if not covered.where("_ld_others IS NOT NULL").isEmpty():
        joined = _tell_apart(joined)
    gone = F.array_distinct(
        F.flatten(F.transform("_ld_starts", lambda at: F.sequence(at, at + F.lit(window - 1))))
    )
    kept = F.when(F.col("_ld_starts").isNull(), F.col("_ld_lines")).otherwise(
        F.transform(
            F.array_except(F.sequence(F.lit(0), F.size("_ld_lines") - 1), gone),
            lambda i: F.element_at("_ld_lines", i + 1),
        )
    )
    return joined.withColumn("_ld_kept", kept)


def remove_repeated_lines(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with their columns, without later occurrences of repeated windows.

    ``n_chars``, where there is one, follows the text.  Documents that lose every line are
    dropped: all they held stands elsewhere.
    """
    decided = _decide(documents, window).where("_ld_starts IS NULL OR size(_ld_kept) > 0")
    text = F.when(F.col("_ld_starts").isNull(), F.col("text")).otherwise(F.array_join("_ld_kept", "\n"))
    columns = {"text": text}
    if "n_chars" in documents.columns:
        columns["n_chars"] = F.when(F.col("_ld_starts").isNull(), F.col("n_chars")).otherwise(F.length(text))
    return decided.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in documents.columns])


def line_decisions(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: its lines, the lines removed, and the text that stays."""
    decided = _decide(documents, window)
    size = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("_ld_lines")).cast("bigint")
    kept = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("_ld_kept")).cast("bigint")
    return decided.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        size.alias("n_lines"),
        (size - kept).alias("n_removed"),
        F.when(F.col("text").isNotNull(), F.array_join("_ld_kept", "\n")).alias("kept_text"),
    )


ORACLE = """
WITH lines AS (
  SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, string_split(text, chr(10)) AS l
  FROM documents WHERE text IS NOT NULL
), spread AS (
  SELECT doc_id, unnest(range(n_lines)) AS pos, unnest(l) AS line FROM lines
), windows AS (
  SELECT doc_id, pos, line AS a,
         lead(line, 1) OVER (PARTITION BY doc_id ORDER BY pos) AS b,
         lead(line, 2) OVER (PARTITION BY doc_id ORDER BY pos) AS c
  FROM spread
), counted AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth
  FROM windows WHERE c IS NOT NULL AND trim(a || b || c) <> ''
), gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM counted, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1
), kept AS (
  SELECT s.doc_id, count(g.pos) AS n_removed,
         string_agg(s.line, chr(10) ORDER BY s.pos) FILTER (WHERE g.pos IS NULL) AS kept_text
  FROM spread s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.pos = g.pos GROUP BY s.doc_id
)
SELECT d.doc_id, coalesce(l.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.kept_text, '') END AS kept_text
FROM documents d LEFT JOIN lines l USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
