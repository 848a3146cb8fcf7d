"""Overlapping, token-bounded chunks that end near semantic breaks.

The text is cut at its breaks by one regex split, every piece is tokenized once,
and a fold over the pieces decides the chunk ends.  All of it happens inside the
document's own row: no shuffle, and work linear in the length of the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.functions.ids import chunk_id
from chunkwright.functions.text import BLANK, empty_array, let
from chunkwright.functions.tokens import LOSSLESS, Tokenizer, get_tokenizer
from chunkwright.functions.vocabulary import VocabularyTokenizer

# A line that starts here is a heading, or is blank, or has a rule line below it.
BREAK_LINE = (
    rf"{BLANK}*+#"
    rf"|{BLANK}*+(?:\n|\z)"
    rf"|[^\n]*+\n{BLANK}*+(?:=++|-++){BLANK}*+(?:\n|\z)"
)
# Every piece but the last ends in a newline, which the split takes away.
_BREAK_SPLIT = rf"\n(?={BREAK_LINE})"
# The same for texts without a line that starts like a rule; the title line above a rule need not be looked through.
_RULE_START = rf"\n{BLANK}*[=-]"
_RULELESS_SPLIT = rf"\n(?={BLANK}*+(?:#|\n|\z))"
# Offset 0 is a break for a heading or a ruled line, not for a blank line.
_BREAK_AT_START = (
    rf"\A(?:{BLANK}*+#|[^\n]*+\n{BLANK}*+(?:=++|-++){BLANK}*+(?:\n|\z))"
)

_BLOCK = 512


@dataclass(frozen=True)
class ChunkOptions:
    """Chunk size settings, in tokens."""

    max_tokens: int = 4096
    overlap: int = 128
    tolerance_pct: float = 10
    semantic_breaks: bool = True
    tokenizer: str | Tokenizer | VocabularyTokenizer = "lossless"

    @property
    def tolerance(self) -> int:
        return int(self.max_tokens * (self.tolerance_pct / 100.0))

    def __post_init__(self):
        if self.max_tokens <= 0:
            raise ValueError("max_tokens must be positive")
        if self.overlap < 0 or self.tolerance < 0:
            raise ValueError("overlap and tolerance must not be negative")
        tolerance = self.tolerance if self.semantic_breaks else 0
        if self.overlap + tolerance >= self.max_tokens:
            raise ValueError("overlap + tolerance must be less than max_tokens")


def break_pieces(text: Column) -> Column:
    """Text cut at its semantic breaks; an empty last piece means a break at the end."""
    cut = F.when(text.rlike(_RULE_START), F.split(text, _BREAK_SPLIT, -1)).otherwise(F.split(text, _RULELESS_SPLIT, -1))
    return let(
        cut, lambda pieces: F.transform(pieces, lambda p, i: F.when(i < F.size(pieces) - 1, F.concat(p, F.lit("\n"))).otherwise(p))
    )


def semantic_breaks(text: Column) -> Column:
    """Sorted character offsets of the semantic breaks as ``ARRAY<INT>``.

    The running sum of piece lengths grows its output block by block, so that a text
    with very many breaks does not copy the whole array once per break.
    """
    lengths = F.transform(break_pieces(text), F.length)

    def blocks(all_lengths: Column) -> Column:
        # The last piece ends at no break.
        inner = F.slice(all_lengths, 1, F.size(all_lengths) - 1)
        return F.transform(
            F.sequence(F.lit(0), F.floor(F.size(all_lengths) / _BLOCK).cast("int")),
            lambda b: F.slice(inner, b * _BLOCK + 1, _BLOCK),
        )

    def grow(acc: Column, block: Column) -> Column:
        inside = F.aggregate(
            block,
            F.struct(acc["at"].alias("at"), empty_array("int").alias("out")),
            lambda a, n: F.struct(
                (a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"] + n)).alias("out")
            ),
        )
        return let(inside, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], r["out"]).alias("out")))

    later = F.aggregate(
        let(lengths, blocks),
        F.struct(F.lit(0).alias("at"), empty_array("int").alias("out")),
        grow,
        lambda acc: acc["out"],
    )
    return F.concat(F.when(text.rlike(_BREAK_AT_START), F.array(F.lit(0))).otherwise(empty_array("int")), later)


def _chunk_ends(opt: ChunkOptions) -> str:
    """SQL of the fold over ``_tokenized``, the tokens of each piece, to the chunk ends.

    ``start`` is where the open chunk begins and ``done`` how many tokens are behind us;
    ``done`` is itself the latest break.  A chunk is decided at the first piece that runs
    past its target, when the nearest break on either side is known.  A piece may hold
    many chunk ends; those beyond the first lie at even steps.
    """
    size, overlap, tol = opt.max_tokens, opt.overlap, opt.tolerance
    step = size - overlap
    none = "cast(array() AS array<int>)"
    before = f"acc.done >= at.target - {tol}"
    after = f"NOT at.last AND at.stop <= at.target + {tol}"
    chars_before = "length(array_join(slice(p, 1, at.target - acc.done), ''))"
    chars_after = "length(array_join(slice(p, at.target - acc.done + 1, at.stop - at.target), ''))"
    first = f"""CASE
      WHEN {before} AND {after} THEN CASE WHEN {chars_before} <= {chars_after} THEN acc.done ELSE at.stop END
      WHEN {before} THEN acc.done
      WHEN {after} THEN at.stop
      ELSE at.target END"""
    # How many more targets this piece passes for good, and whether its own end closes one.
    passed = f"cast(ceil((at.stop - if(at.last, 0, {tol}) - first - {step}) / {step}) AS int)"
    rest = f"""concat(
      if(n > 0, transform(sequence(0, n - 1), i -> first + (i + 1) * {step}), {none}),
      if(NOT at.last AND first < at.stop AND first + (n + 1) * {step} < at.stop, array(at.stop), {none}))"""
    settled = f"""transform(array({first}), first ->
      concat(array(first), transform(array(greatest({passed}, 0)), n -> {rest})[0]))[0]"""
    return f"""aggregate(
      _tokenized,
      named_struct('pieces', 0, 'start', 0, 'done', 0, 'ends', {none}),
      (acc, p) -> transform(
        array(named_struct('pieces', acc.pieces + 1, 'last', acc.pieces + 1 = size(_tokenized),
          'stop', acc.done + size(p), 'target', acc.start + {size})),
        at -> CASE
          WHEN at.stop <= at.target THEN named_struct(
            'pieces', at.pieces, 'start', acc.start, 'done', at.stop, 'ends', acc.ends)
          ELSE transform(array({settled}), e -> named_struct(
            'pieces', at.pieces, 'start', element_at(e, -1) - {overlap}, 'done', at.stop, 'ends', concat(acc.ends, e)))[0] END)[0],
      acc -> CASE
        WHEN acc.done = 0 OR (size(acc.ends) > 0 AND acc.start + {overlap} = acc.done) THEN acc.ends
        ELSE concat(acc.ends, array(acc.done)) END)"""


def chunk_spans(df: DataFrame, opt: ChunkOptions, text: str = "text") -> DataFrame:
    """One row per chunk: the input columns but the text, plus index, offsets and chunk text.

    Rows with an empty text give no chunk.  A tokenizer whose tokens do not rejoin fails the job.
    """
    keep = [c for c in df.columns if c != text]
    tokenizer = get_tokenizer(opt.tokenizer)
    if isinstance(tokenizer, VocabularyTokenizer):
        return _vocabulary_spans(df, opt, tokenizer, text)
    cut = break_pieces(F.col(text)) if opt.semantic_breaks else F.array(F.col(text))
    if tokenizer is LOSSLESS:
        tokenized = df.select(*keep, tokenizer.encode_pieces(cut).alias("_tokenized"))
    else:
        # Chunk texts are made of token texts, so tokens that do not rejoin would lose text.
        tokenized = df.select(*keep, cut.alias("_cut")).select(
            *keep, "_cut", tokenizer.encode_pieces(F.col("_cut")).alias("_tokenized")
        )
        rejoined = F.transform("_tokenized", lambda t: F.array_join(t, ""))
        why = F.raise_error(F.lit(f"tokens of {tokenizer.name} do not rejoin to the text"))
        checked = F.when(F.col("_cut").isNull() | rejoined.eqNullSafe(F.col("_cut")), F.col("_tokenized")).otherwise(why)
        tokenized = tokenized.withColumn("_tokenized", checked)
    ends = tokenized.select(*keep, F.flatten("_tokenized").alias("_tokens"), F.expr(_chunk_ends(opt)).alias("_ends"))
    spans = f"""transform(_ends, (stop, i) -> transform(
      array(if(i = 0, 0, get(_ends, i - 1) - {opt.overlap})),
      start -> named_struct('token_start', start, 'token_end', stop,
        'text', array_join(slice(_tokens, start + 1, stop - start), '')))[0])"""
    # The outer generator gets no inferred size filter, which would run the fold twice.
    return (
        ends.select(
            *keep,
            F.size("_ends").alias("total_chunks"),
            F.posexplode_outer(F.expr(spans)).alias("chunk_index", "_span"),
        )
        .where(F.col("_span").isNotNull())
        .select(
            *keep,
            "chunk_index",
            "total_chunks",
            F.col("_span.token_start").alias("token_start"),
            F.col("_span.token_end").alias("token_end"),
            F.col("_span.text").alias("text"),
        )
    )


def _vocabulary_spans(df: DataFrame, opt: ChunkOptions, tokenizer: VocabularyTokenizer, text: str) -> DataFrame:
    """The rows of ``chunk_spans`` for tokens that may reach across breaks.

    Breaks are found by column functions; tokens, and the ends they allow, in one pass of Arrow batches.
    """
    keep = [c for c in df.columns if c != text]
    breaks = semantic_breaks(F.col(text)) if opt.semantic_breaks else empty_array("int")
    marked = df.select(*keep, F.col(text).alias("_text"), breaks.alias("_breaks"))
    return tokenizer.chunk_rows(marked, "_text", "_breaks", opt.max_tokens, opt.overlap, opt.tolerance)


def chunk_documents(
    documents: DataFrame,
    options: ChunkOptions | None = None,
    created_at: Column | str | None = None,
) -> DataFrame:
    """Chunk records of documents ``(project, file_path, file_name, text, file_sha1)``.

    ``created_at`` fixes the time stamp; by default it is the start of the query.
    """
    opt = options or ChunkOptions()
    keys = ["project", "file_path", "file_name", "file_sha1"]
    return chunk_records(chunk_spans(documents.select(*keys, "text"), opt), opt, created_at)


def chunk_records(spans: DataFrame, opt: ChunkOptions, created_at: Column | str | None = None) -> DataFrame:
    """Chunk records of chunk spans with the columns of their documents."""
    if created_at is None:
        created_at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    stamp = created_at if isinstance(created_at, Column) else F.lit(created_at)
    return spans.select(
        chunk_id(F.col("project"), F.col("file_path"), F.col("chunk_index"), F.col("file_sha1")).alias("chunk_id"),
        "project",
        "file_path",
        "file_name",
        "chunk_index",
        "total_chunks",
        "token_start",
        "token_end",
        "text",
        F.struct(
            F.col("project").alias("project_name"),
            F.lit("markdown").alias("source_format"),
            stamp.alias("created_at"),
            F.col("file_sha1"),
            F.lit(get_tokenizer(opt.tokenizer).name).alias("tokenizer"),
        ).alias("metadata"),
    )


def project_stats(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Files and chunks per project; files without chunks count as files.

    Both sides are counted first, so only one row per project meets in the join.
    """
    files = documents.groupBy("project").agg(F.count("*").alias("files"))
    made = chunks.groupBy("project").agg(F.count("*").alias("chunks"))
    return files.join(made, "project", "left").select(
        "project", "files", F.coalesce("chunks", F.lit(0)).cast("bigint").alias("chunks")
    )


def corpus_totals(stats: DataFrame) -> DataFrame:
    """One row per project and one, with NULL project, for all of them."""
    return stats.rollup("project").agg(
        F.count("*").alias("projects"), F.sum("files").alias("files"), F.sum("chunks").alias("chunks")
    )
