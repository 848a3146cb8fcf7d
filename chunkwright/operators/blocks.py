"""Chunks of texts too long for one task, equal to those of ``chunk_spans``.

A text comes as blocks that begin at line starts.  Where a chunk ends depends on where it begins and on the
breaks near its end alone, so a block is a function: from where the first chunk that begins in it begins to where the
first chunk of the next block does.  A chunk begins at one of few places after a block's begin, so the function
is a short array.  Every block computes its own, with the head of the blocks behind it for the chunks that
reach over its end; the functions of all blocks before each one are composed by doubling, in as many
rounds as the number of blocks has binary digits; and then every block cuts its chunks at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright.functions.text import BLANK, empty_array
from chunkwright.functions.tokens import LOSSLESS, TOKEN_PATTERN, get_tokenizer
from chunkwright.operators.chunking import BREAK_LINE, ChunkOptions, chunk_records, semantic_breaks
from chunkwright.session import durable, once

BLOCK_CHARS = 1 << 20
# Characters and blocks per task: blocks may be short.
TASK_CHARS, TASK_BLOCKS = 16 << 20, 20_000
_RULE_LINE = rf"\A{BLANK}*+(?:=++|-++){BLANK}*+(?:\n|\z)"
_DONE = -1
_FIELDS = [T.StructField(n, T.IntegerType()) for n in ("chunk_index", "token_start", "token_end")] + [T.StructField("text", T.StringType())]


def text_blocks(documents: DataFrame, block_chars: int = BLOCK_CHARS, text: str = "text") -> DataFrame:
    """Texts as rows of blocks: the other columns, ``block`` from 0 and the block's ``text``.

    Blocks begin at line starts and have ``block_chars`` characters or, for the sake of a long line, more.
    """
    kept = [f for f in documents.schema if f.name != text]
    schema = T.StructType([*kept, T.StructField("block", T.IntegerType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(f.name) for f in kept]
            rows, numbers, parts, held = [], [], [], 0

            def made() -> pa.RecordBatch:
                taken = [c.take(pa.array(rows, pa.int32())) for c in columns]
                return pa.RecordBatch.from_arrays([*taken, pa.array(numbers, pa.int32()), pa.array(parts, pa.string())], schema.names)

            for n, whole in enumerate(batch.column(text)):
                whole, at, number = whole.as_py() or "", 0, 0
                while at < len(whole):
                    end = whole.find("\n", at + block_chars - 1) + 1 or len(whole)
                    rows.append(n)
                    numbers.append(number)
                    parts.append(whole[at:end])
                    held += end - at
                    at, number = end, number + 1
                    if held >= BLOCK_CHARS:
                        yield made()
                        rows, numbers, parts, held = [], [], [], 0
            if rows:
                yield made()

    return documents.mapInArrow(run, schema)


def block_tasks(blocks: int, chars: int, cores: int) -> int:
    """Tasks for so many blocks: bounded by what they hold, so that short blocks do not make many tasks."""
    return int(max(2 * cores, chars // TASK_CHARS + 1, blocks // TASK_BLOCKS + 1))


class _Tokens:
    """Ends of tokens in characters, and breaks as numbers of tokens before them, of a block and the heads behind it."""

    def __init__(self, row: dict, reach: int):
        text, breaks, behind = row["text"], list(row["_breaks"]), 0
        for head in row["_heads"]:
            if behind >= reach:
                break
            breaks += [len(text) + b for b in head["breaks"]]
            text += head["text"]
            behind += head["n"]
        lengths = np.fromiter((len(t) for t in re.findall(TOKEN_PATTERN, text)), np.int64)
        self.text, self.chars = text, np.concatenate([[0], np.cumsum(lengths)])
        # The text ends in sight if all that stands behind the block is in its heads.
        self.count, self.ends_here = len(lengths), row["_last"] or row["_ends_behind"] and behind <= reach
        self.breaks = np.searchsorted(self.chars, np.unique(np.array(breaks, np.int64)))

    def ends(self, start: np.ndarray, size: int, tolerance: int) -> np.ndarray:
        """Where chunks that begin at ``start`` end: at the nearest break to their size, if one is near."""
        end = start + size
        if self.ends_here:
            end = np.minimum(end, self.count)
        if not len(self.breaks):
            return end
        at = np.searchsorted(self.breaks, end, "right")
        before = self.breaks[np.maximum(at - 1, 0)]
        after = self.breaks[np.minimum(at, len(self.breaks) - 1)]
        near = (at > 0) & (before >= end - tolerance), (at < len(self.breaks)) & (after <= end + tolerance)
        # Positions beyond what is known here are neither near a break nor an end.
        place = lambda k: self.chars[np.minimum(k, self.count)]
        far = [np.where(n, np.abs(place(b) - place(end)), np.iinfo(np.int64).max) for n, b in zip(near, (before, after))]
        best = np.where(far[0] <= far[1], before, after)
        open_end = ~(self.ends_here & (end == self.count))
        return np.where(open_end & (near[0] | near[1]), best, end)


def _function(tokens: _Tokens, own: int, entries: int, opt: ChunkOptions) -> tuple[np.ndarray, np.ndarray]:
    """Per place where the first chunk may begin: where that of the next block begins, and how many chunks begin here."""
    place, count = np.arange(entries), np.zeros(entries, np.int64)
    live = place < own
    while live.any():
        ends = tokens.ends(place[live], opt.max_tokens, opt.tolerance if opt.semantic_breaks else 0)
        count[live] += 1
        over = tokens.ends_here & (ends >= tokens.count)
        place[live] = np.where(over, _DONE, ends - opt.overlap)
        live = (place >= 0) & (place < own)
    return np.where(place >= 0, place - own, _DONE), count


def _neighbours(blocks: DataFrame, keys: list[str], opt: ChunkOptions) -> DataFrame:
    """Blocks with their breaks, their first token's number, and the heads of the blocks behind them as far as chunks may reach."""
    order = Window.partitionBy(*keys).orderBy("block")
    reach = opt.max_tokens + opt.tolerance
    tokens = F.regexp_extract_all("text", F.lit(TOKEN_PATTERN), F.lit(0))
    none = empty_array("int")
    # A break at the very end is one of the text only where the text ends; the next block knows its own first line.
    inside = semantic_breaks(F.col("text")) if opt.semantic_breaks else none
    first = F.when((F.col("block") > 0) & F.regexp_like("text", F.lit(rf"\A(?:{BREAK_LINE})")), F.array(F.lit(0)))
    # The blocks of one text come out of one task: from here on they are dealt over all of them.
    kept = durable(blocks.select(*keys, "block", "text"), "text-blocks")
    size = kept.agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.length("text")).alias("chars")).first()
    tasks = block_tasks(size.blocks, size.chars or 0, kept.sparkSession.sparkContext.defaultParallelism)
    dealt = once(kept.repartition(tasks, *keys, "block"), {"_tokens": tokens})
    lines = F.regexp_replace("text", r"\n\z", "")
    sized = durable(
        dealt.select(
            *keys, "block", "text", F.size("_tokens").alias("_n"), F.array_join(F.slice("_tokens", 1, reach), "").alias("_head"),
            F.concat(F.coalesce(first, none) if opt.semantic_breaks else none, inside).alias("_inside"),
            F.regexp_like("text", F.lit(_RULE_LINE)).alias("_rule"), F.length("text").alias("_length"),
            (F.length(lines) - F.length(F.substring_index(lines, "\n", -1))).alias("_last_line"),
        ),
        "blocks",
    )
    # All blocks of a text meet in one task below, but for their texts: heads are as short as a chunk.
    placed = sized.drop("text").withColumns(
        {"_last": F.lead("block").over(order).isNull(), "_ruled": F.coalesce(F.lead("_rule").over(order), F.lit(False)),
         "_first": (F.sum("_n").over(order) - F.col("_n")).cast("bigint")}
    )
    # Below the last line of a block the next one may begin with a rule.
    ruled = F.when(F.col("_ruled"), F.array("_last_line")).otherwise(none) if opt.semantic_breaks else none
    own = F.concat(F.filter("_inside", lambda b: F.col("_last") | (b < F.col("_length"))), ruled)
    marked = durable(placed.select(*keys, "block", "_n", "_first", "_last", "_head", own.alias("_breaks")), "marked-blocks")
    fewest = marked.where(~F.col("_last")).agg(F.min("_n")).first()[0] or reach
    behind = order.rowsBetween(1, -(-reach // max(int(fewest), 1)))
    head = F.struct(
        F.col("_head").alias("text"), F.least("_n", F.lit(reach + 1)).alias("n"),
        F.filter("_breaks", lambda b: b <= F.length("_head")).alias("breaks"),
    )
    beside = marked.select(
        *keys, "block", "_n", "_first", "_last", "_breaks", F.collect_list(head).over(behind).alias("_heads"),
        F.coalesce(F.bool_or("_last").over(behind), F.lit(False)).alias("_ends_behind"),
    )
    return durable(sized.select(*keys, "block", "text").repartition(tasks, *keys, "block").join(beside, [*keys, "block"]), "block-neighbours")


def chunk_blocks(blocks: DataFrame, keys: list[str], options: ChunkOptions | None = None) -> DataFrame:
    """One row per chunk of texts in blocks: keys, ``chunk_index, total_chunks, token_start, token_end, text``.

    Needs the ``lossless`` tokenizer, whose tokens never reach over a line start.
    """
    opt = options or ChunkOptions()
    if get_tokenizer(opt.tokenizer) is not LOSSLESS:
        raise ValueError("blocks need the lossless tokenizer")
    known = _neighbours(blocks, keys, opt)
    reach, entries = opt.max_tokens + opt.tolerance, opt.max_tokens + opt.tolerance - opt.overlap
    own_fields = [f for f in known.schema if f.name in (*keys, "block")]

    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A text is entered at its begin alone.
            found = [_function(_Tokens(row, reach), row["_n"], entries if row["block"] else 1, opt) for row in batch.to_pylist()]
            arrays = [pa.array([f[i].tolist() for f in found], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in own_fields), *arrays], [*(f.name for f in own_fields), "_to", "_count"])

    steps = T.StructType([*own_fields, *(T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("_to", "_count"))])
    composed = _composed(durable(known.mapInArrow(functions, steps), "block-functions"), keys)
    total = composed.groupBy(*keys).agg(F.max(F.get("_count", F.lit(0))).alias("total_chunks"))
    before = composed.select(*keys, (F.col("block") + 1).alias("block"), F.get("_to", F.lit(0)).alias("_entry"), F.get("_count", F.lit(0)).alias("_index"))
    start = known.join(before, [*keys, "block"], "left").join(total, keys).withColumns(
        {"_entry": F.when(F.col("block") == 0, 0).otherwise(F.col("_entry")), "_index": F.when(F.col("block") == 0, 0).otherwise(F.col("_index"))}
    )
    kept = [f for f in start.schema if f.name in (*keys, "total_chunks")]
    schema = T.StructType([*kept, *_FIELDS])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, row in enumerate(batch.to_pylist()):
                at, index, found = row["_entry"], row["_index"], []
                if at == _DONE or at >= row["_n"]:
                    continue
                tokens = _Tokens(row, reach)
                while 0 <= at < row["_n"]:
                    end = int(tokens.ends(np.array([at]), opt.max_tokens, opt.tolerance if opt.semantic_breaks else 0)[0])
                    found.append((index, row["_first"] + at, row["_first"] + end, tokens.text[tokens.chars[at] : tokens.chars[end]]))
                    index += 1
                    at = _DONE if tokens.ends_here and end >= tokens.count else end - opt.overlap
                repeated = [batch.column(f.name).take(pa.array([n] * len(found))) for f in kept]
                numbers = [pa.array(x, pa.int32()) for x in list(zip(*found))[:3]]
                yield pa.RecordBatch.from_arrays([*repeated, *numbers, pa.array([f[3] for f in found], pa.string())], schema.names)

    columns = [*(f.name for f in kept), "block", "_n", "_first", "_last", "text", "_breaks", "_heads", "_ends_behind", "_entry", "_index"]
    chunks = start.select(*columns).mapInArrow(cut, schema)
    return chunks.select(*keys, "chunk_index", "total_chunks", "token_start", "token_end", "text")


def _composed(functions: DataFrame, keys: list[str]) -> DataFrame:
    """Per block the function of all blocks up to it, from the text's begin on."""
    most = functions.agg(F.max("block")).first()[0] or 0
    step = 1
    while step <= most:
        earlier = functions.select(*keys, (F.col("block") + step).alias("block"), F.col("_to").alias("_f"), F.col("_count").alias("_c"))
        both = functions.join(earlier, [*keys, "block"], "left")
        to = f"if(_f is null, _to, transform(_f, x -> if(x < 0, {_DONE}, _to[x])))"
        count = "if(_f is null, _count, transform(_f, (x, i) -> _c[i] + if(x < 0, 0, _count[x])))"
        functions = durable(both.select(*keys, "block", F.expr(to).alias("_to"), F.expr(count).alias("_count")), "block-functions")
        step *= 2
    return functions


def chunk_large_documents(
    documents: DataFrame, options: ChunkOptions | None = None, created_at: Column | str | None = None, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The chunk records of ``chunk_documents``, for texts that are cut by many tasks each."""
    opt = options or ChunkOptions()
    keys = ["project", "file_path", "file_name", "file_sha1"]
    spans = chunk_blocks(text_blocks(documents.select(*keys, "text"), block_chars), keys, opt)
    return chunk_records(spans, opt, created_at)
