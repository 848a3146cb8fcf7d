"""Stage one: markdown folders to chunk lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.functions.tokens import LOSSLESS, get_tokenizer
from chunkwright.operators.blocks import chunk_large_documents
from chunkwright.operators.chunking import ChunkOptions, chunk_documents, corpus_totals, project_stats
from chunkwright.operators.validation import require_valid
from chunkwright.session import configure, durable, spread
from chunkwright.sources.jsonl import read_chunks, write_chunks
from chunkwright.sources.markdown import read_markdown


# Characters from which on a text is cut by many tasks instead of one.
LARGE_CHARS = 16 << 20


def chunk_corpus(
    spark: SparkSession,
    input_root: str,
    workspace: str,
    options: ChunkOptions | None = None,
    created_at: str | None = None,
    large_chars: int = LARGE_CHARS,
) -> DataFrame:
    """Write ``workspace/chunks`` and return files and chunks per project and in all.

    Malformed files are set aside in ``workspace/unreadable`` and do not stop the others.  Texts of more than
    ``large_chars`` characters are cut in blocks, unless a tokenizer of your own cuts them.
    """
    configure(spark)
    # The files are read once; from here on columns are read as needed.
    documents = spread(durable(read_markdown(spark, input_root, strict=False), "documents"), "project", "file_path")
    unreadable = documents.where(F.col("text").isNull()).drop("text")
    unreadable.write.mode("overwrite").json(f"{workspace}/unreadable")
    readable = documents.where(F.col("text").isNotNull())
    chunks = require_valid(_chunks(readable, options or ChunkOptions(), created_at, large_chars), "chunk")
    write_chunks(chunks, f"{workspace}/chunks")
    return corpus_totals(project_stats(readable, read_chunks(spark, f"{workspace}/chunks")))


def _chunks(documents: DataFrame, options: ChunkOptions, created_at: str | None, large_chars: int) -> DataFrame:
    large = documents.where(F.length("text") > large_chars)
    if get_tokenizer(options.tokenizer) is not LOSSLESS or large.isEmpty():
        return chunk_documents(documents, options, created_at)
    rest = chunk_documents(documents.where(F.length("text") <= large_chars), options, created_at)
    return rest.unionByName(chunk_large_documents(large, options, created_at))
