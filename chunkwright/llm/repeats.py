"""Removal of repeated passages by seed and extend over winnowed anchors.

A window is ``WINDOW`` consecutive words of a document.  A window is later where its words also
start earlier (smaller ``doc_id``, or the same document and an earlier start); every word that a
later window covers goes.  Windows are judged on the input, not on what is left.

1. Winnowing: the ``GRAM`` words of least hash within a window are its anchor (the first of equal
   ones), so equal windows have equal anchors at equal places.  Neighbouring windows with one anchor
   are a span: the anchor, extended both ways as far as it is the anchor (``anchor_spans``).
2. Documents join on anchors: anchors that stand once in the corpus hold no repeat and go, the others
   are seeds.
3. Seeds with equal spans match over the whole extension; all but the first are later (``whole_spans``).
   Where one anchor stands in different spans, a match ends inside of them: of each different span the
   first occurrence, and of it every window, is compared (``partial_spans``).
4. Matches that overlap merge to maximal repeats, whose words go.

No pairs of documents are made: occurrences meet their group's first one, found by an aggregation that
combines before the shuffle, so a passage in a third of all documents is one row per task.  Words enter
as 64-bit hashes; spans and windows are told apart by 128 bits.

Null and empty texts, and texts of fewer than ``WINDOW`` words, stay as they are.  Null ``doc_id``
sorts first.  Rows that share a ``doc_id`` are told apart by a hash of their text; of equal rows one,
whichever it is, stands before the others, which so lose every word if they hold a window.  An empty
table gives an empty table.  Very long texts are hashed in steps of ``STEP_WORDS`` words.  All
columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright.llm.shared import ragged, text_parts
from chunkwright.session import discard, durable, stored

WINDOW = 20
GRAM = 7
# Bytes of text, and words of one text, worked on at a time.
STEP_BYTES = 2 << 20
STEP_WORDS = 1 << 18
# Word hashes kept per task before the store starts anew; bounds memory, not results.
WORDS = 1_000_000

_BASE = 0x9E37_79B9_7F4A_7C15
_OTHER_BASE = 0xD134_2543_DE82_EF95


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58_476D_1CE4_E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D0_49BB_1331_11EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Stretches:
    """Hashes of stretches of consecutive words, by their first words, in one multiplication each."""

    def __init__(self, words: np.ndarray, base: int = _BASE):
        powers, self.back = (np.full(len(words) + 1, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        for array in (powers, self.back):
            array[0] = 1
            np.cumprod(array, out=array)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers[:-1], out=self.sums[1:])

    def hashes(self, first: np.ndarray, count: np.ndarray | int) -> np.ndarray:
        return _mix((self.sums[first + count] - self.sums[first]) * self.back[first])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value of every ``width`` neighbours."""
    place, covered = np.arange(len(values)), 1
    while covered < width:
        step = min(covered, width - covered)
        n = len(values) - step
        later = values[step:] < values[:n]
        values, place = np.where(later, values[step:], values[:n]), np.where(later, place[step:], place[:n])
        covered += step
    return place


def _spans(words: np.ndarray, text: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor and words' hash of every span of texts of word hashes, end to end."""
    stretches = Stretches(words)
    grams = stretches.hashes(np.arange(len(words) - gram + 1), gram)
    anchor = _least(grams, window - gram + 1)
    first = np.flatnonzero(np.arange(len(anchor)) + window <= ends[: len(anchor)])
    anchor = anchor[first]
    new = np.ones(len(first), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[first[1:]] != text[first[:-1]])
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate([at, [len(first)]]))
    first, anchor = first[at], anchor[at]
    whole = _mix(stretches.hashes(first, count + window - 1) + (count * window + anchor - first).astype(np.uint64))
    return first, count, grams[anchor], whole


def _word_hashes(rows: list[list[bytes]], hashes: _WordHashes) -> np.ndarray:
    if len(hashes) > WORDS:
        hashes.clear()
    return np.fromiter((hashes[w] for row in rows for w in row), np.uint64, sum(map(len, rows)))


def copy_column(documents: DataFrame) -> Column:
    """What tells rows of one ``doc_id`` apart: nothing where ids are unique, else a hash of the text."""
    shared = documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return F.lit(0).cast("bigint") if shared.isEmpty() else F.xxhash64("text")


def keyed(documents: DataFrame, copy: Column) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), copy.alias("copy"), "text")


KEYS = "doc_id bigint, copy bigint"


class Steps:
    """Results of steps, written to the shared folder and dropped when nothing reads them any more.

    Spark drops the shuffle files of a step once the driver's collector finds that nothing refers to
    them; asked for after every step, only one step's files lie on the executors' disks at a time.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        result, self.paths[name] = stored(df, name)
        self.spark.sparkContext._jvm.System.gc()
        return result

    def drop(self, *names: str) -> None:
        discard(self.spark, *map(self.paths.pop, names))


def anchor_spans(documents: DataFrame, copy: Column, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, copy, at, n, anchor, span`` of all spans: ``n`` windows from word ``at`` on, with one anchor."""

    def step(part: pa.RecordBatch, hashes: _WordHashes) -> Iterator[pa.RecordBatch]:
        rows = [raw.split() for raw in part.column("text").cast(pa.binary()).to_pylist()]
        lengths = np.array([len(r) for r in rows], np.int64)
        words = _word_hashes(rows, hashes)
        del rows
        # Windows of a long text are dealt to several steps; where spans are cut matters to no result.
        texts = np.repeat(np.arange(len(lengths)), lengths)
        ends = np.repeat(np.cumsum(lengths), lengths)
        base = np.cumsum(lengths) - lengths
        for low in range(0, len(words), STEP_WORDS):
            high = min(len(words), low + STEP_WORDS + window - 1)
            if high - low < window:
                continue
            first, n, anchor, span = _spans(words[low:high], texts[low:high], np.minimum(ends[low:high], high) - low, window, gram)
            first += low
            text = texts[first]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(text)), part.column("copy").take(pa.array(text)),
                 pa.array(first - base[text], pa.int32()), pa.array(n, pa.int32()), pa.array(anchor.view(np.int64)), pa.array(span.view(np.int64))],
                ["doc_id", "copy", "at", "n", "anchor", "span"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for part in text_parts(batch, "text", STEP_BYTES):
                yield from step(part, hashes)

    return keyed(documents, copy).where("text IS NOT NULL").mapInArrow(run, f"{KEYS}, at int, n int, anchor bigint, span bigint")


def _place() -> Column:
    return F.struct("doc_id", "copy", "at")


def whole_spans(seeds: DataFrame, classes: DataFrame) -> DataFrame:
    """Occurrences of spans after the first of equal ones: ``doc_id, copy, at, n``."""
    found = seeds.join(classes.where("occurrences > 1").select("anchor", "span", "first"), ["anchor", "span"])
    return found.where(~_place().eqNullSafe(F.col("first"))).select("doc_id", "copy", "at", "n")


def partial_spans(documents: DataFrame, copy: Column, classes: DataFrame, steps: Steps, window: int = WINDOW) -> DataFrame:
    """Later windows within first occurrences of spans that share their anchor with others: ``doc_id, copy, at, n``."""
    shared = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("spans")).where("spans > 1").select("anchor")
    leaders = classes.join(shared, "anchor").select("first.*", "n")
    listed = leaders.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("at", "n")).alias("spans"))

    def step(part: pa.RecordBatch, hashes: _WordHashes) -> Iterator[pa.RecordBatch]:
        rows = [raw.split() for raw in part.column("text").cast(pa.binary()).to_pylist()]
        lengths = np.array([len(r) for r in rows], np.int64)
        words = _word_hashes(rows, hashes)
        spans = part.column("spans")
        text = np.repeat(np.arange(len(rows)), spans.value_lengths().to_numpy())
        at, n = (spans.flatten().field(name).to_numpy().astype(np.int64) for name in ("at", "n"))
        text, at = np.repeat(text, n), ragged(at, n)
        first = (np.cumsum(lengths) - lengths)[text] + at
        one, two = Stretches(words), Stretches(words, _OTHER_BASE)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(pa.array(text)), part.column("copy").take(pa.array(text)), pa.array(at, pa.int32()),
             pa.array(one.hashes(first, window).view(np.int64)), pa.array(two.hashes(first, window).view(np.int64))],
            ["doc_id", "copy", "at", "h1", "h2"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for part in text_parts(batch, "text", STEP_BYTES):
                yield from step(part, hashes)

    # One row of equal ones is enough: they hold the same windows.
    wanted = _joined(keyed(documents, copy), F.col("copy"), listed, "inner").select("doc_id", "copy", "text", "spans")
    windows = steps.write(wanted.mapInArrow(run, f"{KEYS}, at int, h1 bigint, h2 bigint"), "windows")
    firsts = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(_place()).alias("first")).where("n > 1").drop("n")
    firsts = steps.write(firsts, "first-windows")
    later = windows.join(firsts, ["h1", "h2"]).where(~_place().eqNullSafe(F.col("first")))
    return later.select("doc_id", "copy", "at", F.lit(1).alias("n"))


def _joined(documents: DataFrame, copy: Column, found: DataFrame, how: str) -> DataFrame:
    """Documents with what was found by key, in a sort-merge join: both sides grow with the corpus."""
    named = found.select(*[F.col(c).alias(f"_sr_{c}") if c in KEY_NAMES else F.col(c) for c in found.columns])
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_sr_doc_id")) & (copy == F.col("_sr_copy"))
    return documents.join(named.hint("merge"), same, how)


KEY_NAMES = ("doc_id", "copy")


def covered_words(documents: DataFrame, copy: Column, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Per document with later windows their first words and numbers, and the keys of documents with equal rows."""
    steps = Steps(documents.sparkSession)
    spans = steps.write(anchor_spans(documents, copy, window, gram), "anchor-spans")
    # Every row with a window has one span at its start.
    equal = spans.where("at = 0").groupBy("doc_id", "copy").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    equal = steps.write(equal.drop("rows"), "equal-rows")
    # What is counted is written before it is joined: only then may Spark split a hot anchor's rows over tasks.
    repeated = spans.groupBy("anchor").agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1").select("anchor")
    seeds = steps.write(spans.join(steps.write(repeated, "repeated-anchors"), "anchor"), "seeds")
    steps.drop("anchor-spans", "repeated-anchors")
    classes = seeds.groupBy("anchor", "span").agg(F.count(F.lit(1)).alias("occurrences"), F.min(_place()).alias("first"), F.first("n").alias("n"))
    classes = steps.write(classes, "span-classes")
    whole = steps.write(whole_spans(seeds, classes), "whole-spans")
    steps.drop("seeds")
    later = whole.unionByName(partial_spans(documents, copy, classes, steps, window))
    covered = steps.write(later.groupBy("doc_id", "copy").agg(F.collect_set(F.struct("at", "n")).alias("_sr_spans")), "covered-words")
    steps.drop("span-classes", "whole-spans", "windows", "first-windows")
    return covered, equal


def _decide(documents: DataFrame, window: int, gram: int) -> DataFrame:
    """All columns, the later windows of each row as ``_sr_spans``, and whether all its words go as ``_sr_all``."""
    copy = copy_column(documents)
    covered, equal = covered_words(documents, copy, window, gram)
    joined = _joined(documents, copy, covered, "left").drop("_sr_doc_id", "_sr_copy")
    if equal.isEmpty():
        return joined.withColumn("_sr_all", F.lit(False))
    marked = _joined(joined, copy, equal.withColumn("_sr_equal", F.lit(True)), "left")
    twins = durable(marked.where("_sr_equal").withColumn("_sr_row", F.monotonically_increasing_id()), "twins")
    kept = twins.groupBy("_sr_doc_id", "_sr_copy").agg(F.min("_sr_row").alias("_sr_row")).select("_sr_row", F.lit(True).alias("_sr_kept"))
    told = twins.join(kept, "_sr_row", "left").withColumn("_sr_all", F.col("_sr_kept").isNull())
    single = marked.where("_sr_equal IS NULL").withColumn("_sr_all", F.lit(False))
    return single.select(*joined.columns, "_sr_all").unionByName(told.select(*joined.columns, "_sr_all"))


def _kept(words: list[bytes], spans: list[dict] | None, window: int) -> bytes:
    if not spans:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.array([s["at"] for s in spans])
    np.add.at(edges, at, 1)
    np.add.at(edges, at + np.array([s["n"] for s in spans]) + window - 1, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()])


def _outcomes(decided: DataFrame, window: int, columns: list[str], digests: bool) -> DataFrame:
    """``columns`` with the number of words, the number removed, and the kept words or their digest."""
    types = {f.name: f for f in decided.schema}
    schema = T.StructType([types[c] for c in columns]).add("_sr_words", "long").add("_sr_removed", "long").add("_sr_kept", "string")

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        counts, removed, kept = [], [], []
        rows = zip(*(part.column(c).to_pylist() for c in ("_sr_spans", "_sr_all")), part.column("text").cast(pa.binary()).to_pylist())
        for spans, every, raw in rows:
            words = (raw or b"").split()
            left = b"" if every else _kept(words, spans, window)
            counts.append(len(words))
            removed.append(len(words) - (0 if every else len(words) if not spans else len(left.split())))
            kept.append(hashlib.sha256(left).hexdigest() if digests else left.decode("utf-8"))
        found = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *found], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, "text", STEP_BYTES):
                yield step(part)

    return decided.mapInArrow(run, schema)


def remove_repeated_passages(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The documents, with their columns, without the words of later windows.

    Texts that lose words hold their other words, joined by single blanks; the others stay as they are.
    """
    found = _outcomes(_decide(documents, window, gram), window, documents.columns, digests=False)
    text = F.when(F.col("_sr_removed") > 0, F.col("_sr_kept")).otherwise(F.col("text"))
    return found.select(*[text.alias(c) if c == "text" else F.col(c) for c in documents.columns])


def passage_digests(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document its number of words, of words removed, and a digest of the others."""
    only = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = _outcomes(_decide(only, window, gram), window, ["doc_id"], digests=True)
    return found.select(
        "doc_id", F.col("_sr_words").alias("n_words"), F.col("_sr_removed").alias("n_removed"), F.col("_sr_kept").alias("kept_sha256")
    )


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM texts)
), judged AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1 AS later FROM windows
), gone AS (
  SELECT DISTINCT doc_id, i + k AS pos FROM judged, (SELECT unnest(range(20)) AS k) WHERE later
), spread AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM texts
), kept AS (
  SELECT s.doc_id, count(g.pos) AS n_removed, string_agg(s.word, ' ' ORDER BY s.pos) FILTER (WHERE g.pos IS NULL) AS kept
  FROM spread s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.pos = g.pos GROUP BY s.doc_id
)
SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
