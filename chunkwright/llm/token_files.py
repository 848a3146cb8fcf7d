"""Token ids in binary shards with constant-time access by document key.

A shard file holds the raw ids of its documents in ascending key order, then an index: a
minimal perfect hash over the keys, and per slot the key's fingerprint, its first id and its
number of ids.  Layout (little-endian)::

    ids       n_ids x 2 bytes (4 when the vocabulary has more than 65,536 ids)
    bits      one bit per hash position, levels end to end
    sizes     n_levels x uint64
    records   n_docs x (uint32 fingerprint, uint32 n_ids, uint64 first id)
    footer    8 x uint64: magic, id width, n_docs, n_ids, seed, n_levels, bytes of bits, 0

Null and empty texts hold the end id alone.  Documents that share a ``doc_id`` (null included)
are told apart by ``copy``, their number within the shard; a key with very many rows is dealt over
several shards.  An empty table gives no file, other columns are ignored, and a very long text is encoded
alone, each of its distinct pieces once.  Files are written under a name of
their own and renamed, so a repeated task leaves one whole file.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkwright.llm.mph import PerfectHash
from chunkwright.llm.pretokens import BLANK, PieceEncoder, read_vocabulary, special_tokens, vocabulary_size
from chunkwright.llm.shared import keyed_texts, ragged, text_parts
from chunkwright.session import checkpoint_root, durable

MAGIC = 0x3130_5844_494B_4F54
END_ID = 2
RECORD = np.dtype([("fingerprint", "<u4"), ("count", "<u4"), ("first", "<u8")])
# Bytes of text per shard: bounds the memory of a task and sets the number of shards.
SHARD_BYTES = 32 << 20
# Bytes of text encoded at a time: the arrays of a step take many times as much.
STEP_BYTES = 2 << 20
# Characters of pieces encoded in one row.
ROW_CHARS = 1 << 14
BLANKS = frozenset(filter(re.compile(f"[{BLANK}]").match, map(chr, range(0x3001))))
NULL_KEY = 1 << 40  # added to the copy number of documents without a key


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "", 1))


class LibraryEncoder(PieceEncoder):
    """Encodes each distinct piece once with the tokenizers library, many pieces in one row.

    Pieces of a row stand one after the other as they would in a text, so the library cuts them alike; which
    ids belong to which piece follows from the bytes of the tokens.
    """

    def __init__(self, vocabulary: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(None, special_tokens(vocabulary))
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.token_bytes = np.zeros(vocabulary_size(vocabulary), np.int64)
        # One character of a byte-level token stands for one byte.
        for token, i in json.loads(vocabulary)["model"]["vocab"].items():
            self.token_bytes[i] = len(token)

    def _learn(self) -> None:
        fresh = self.pieces.take()
        rows, row, size, begins = [], [], 0, []
        for number, key in enumerate(fresh):
            if isinstance(key, int):
                continue
            alone = isinstance(key, tuple)
            piece = key[0] if alone else f" {key}"
            if row and (alone or size > ROW_CHARS or row[-1][-1] in BLANKS):
                rows.append("".join(row))
                row, size = [], 0
            row.append(piece)
            size += len(piece)
            begins.append(len(piece) if piece.isascii() else len(piece.encode("utf-8", "replace")))
        if row:
            rows.append("".join(row))
        found = [e.ids for e in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)] if rows else []
        flat = np.fromiter(chain.from_iterable(found), np.int32, sum(map(len, found)))
        ends, bytes_end = np.cumsum(begins, dtype=np.int64), np.cumsum(self.token_bytes[flat])
        upto = np.searchsorted(bytes_end, ends, "right")
        if len(ends) and (upto[-1] != len(flat) or (bytes_end[upto - 1] != ends).any()):
            raise ValueError("tokens do not end where pieces do")
        lengths = np.diff(upto, prepend=0)
        if len(begins) < len(fresh):  # special tokens stand for their own ids
            is_id = np.array([isinstance(key, int) for key in fresh])
            every = np.ones(len(fresh), np.int64)
            every[~is_id] = lengths
            at = np.cumsum(every) - every
            whole = np.zeros(int(every.sum()), np.int32)
            whole[at[is_id]] = [key for key in fresh if isinstance(key, int)]
            whole[ragged(at[~is_id], lengths)] = flat
            flat, lengths = whole, every
        self.piece_ids.extend(flat, lengths)


@lru_cache(maxsize=1)
def library_encoder(vocabulary: str) -> LibraryEncoder:
    """Kept by a worker, with the pieces it has learnt, from task to task."""
    return LibraryEncoder(vocabulary)


class ShardWriter:
    """Streams the ids of one shard and closes it with its index."""

    def __init__(self, root: str, shard: int, width: int):
        self.store, folder = open_store(root)
        self.temp, self.final = f"{folder}/.{uuid.uuid4().hex}", f"{folder}/shard-{shard:08d}.tok"
        self.out = self.store.open_output_stream(self.temp)
        self.width, self.keys, self.copies, self.counts = width, [], [], []

    def add(self, keys: np.ndarray, copies: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.keys.append(keys)
        self.copies.append(copies)
        self.counts.append(counts)

    def close(self) -> None:
        keys, copies, counts = (np.concatenate(x) for x in (self.keys, self.copies, self.counts))
        index = PerfectHash.build(keys, copies)
        slot, fingerprint = index.slots(keys, copies)
        records = np.zeros(len(keys), RECORD)
        records["fingerprint"][slot] = fingerprint
        records["count"][slot] = counts
        records["first"][slot] = np.cumsum(counts) - counts
        bits = np.packbits(index.bits, bitorder="little").tobytes()
        footer = [MAGIC, self.width, len(keys), counts.sum(), index.seed, len(index.sizes), len(bits), 0]
        for part in (bits, np.array(index.sizes, "<u8").tobytes(), records.tobytes(), np.array(footer, "<u8").tobytes()):
            self.out.write(part)
        self.out.close()
        self.store.move(self.temp, self.final)


class ShardReader:
    """Keyed access to one shard file; reads the index once and ids as asked."""

    def __init__(self, root: str, shard: int):
        store, folder = open_store(root)
        self.file = store.open_input_file(f"{folder}/shard-{shard:08d}.tok")
        size = self.file.size()
        footer = np.frombuffer(self.file.read_at(64, size - 64), "<u8").astype(np.int64)
        magic, self.width, docs, self.n_ids, seed, levels, bit_bytes, _ = footer.tolist()
        if magic != MAGIC:
            raise ValueError(f"{folder}/shard-{shard:08d}.tok is not a token file")
        at = self.n_ids * self.width
        tail = self.file.read_at(size - 64 - at, at)
        sizes = np.frombuffer(tail, "<u8", levels, bit_bytes).astype(np.int64).tolist()
        bits = np.unpackbits(np.frombuffer(tail, np.uint8, bit_bytes), count=sum(sizes), bitorder="little").astype(bool)
        self.records = np.frombuffer(tail, RECORD, docs, bit_bytes + 8 * levels)
        self.index = PerfectHash(seed, sizes, bits)

    def find(self, keys: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id and number of ids per key; -1 where the shard does not hold the key."""
        slot, fingerprint = self.index.slots(keys, copies)
        if not len(self.records):
            return slot, slot
        found = self.records[np.maximum(slot, 0)]
        held = (slot >= 0) & (found["fingerprint"] == fingerprint)
        return np.where(held, found["first"].astype(np.int64), -1), np.where(held, found["count"].astype(np.int64), -1)

    def ids(self, first: int, count: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(count * self.width, first * self.width), f"<u{self.width}")


def _key_arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    key = batch.column("doc_id")
    copies = batch.column("copy").to_numpy(zero_copy_only=False).astype(np.int64)
    return key.fill_null(0).to_numpy(), copies + np.where(key.is_null().to_numpy(zero_copy_only=False), NULL_KEY, 0)


CATALOG = "doc_id bigint, copy bigint, shard bigint, n_tokens bigint"


def write_token_files(documents: DataFrame, vocabulary_path: str, root: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all shards below ``root`` and return the catalog, read back from ``root/catalog``."""
    spark = documents.sparkSession
    vocabulary = read_vocabulary(vocabulary_path)
    width = 2 if vocabulary_size(vocabulary) <= 1 << 16 else 4
    store, folder = open_store(root)
    store.create_dir(folder, recursive=True)
    texts = keyed_texts(documents)
    total = texts.select(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    # Rows of one key, even equal ones, may span ranges: they are numbered within the shard.
    numbered = texts.withColumns({"begin": F.substring("text", 1, 64), "row": F.monotonically_increasing_id()})
    ranges = numbered.repartitionByRange(int(shards), "doc_id", "begin", "row")
    placed = ranges.sortWithinPartitions("doc_id", "text").drop("begin", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encoder, writer = TaskContext.get().partitionId(), None, None
        last, copy = object(), 0
        for batch in (part for whole in batches for part in text_parts(whole, "text", STEP_BYTES)):
            if writer is None:
                encoder = library_encoder(vocabulary)
                writer = ShardWriter(root, shard, width)
            copies = []
            for key in batch.column("doc_id").to_pylist():
                copy = copy + 1 if key == last else 0
                last = key
                copies.append(copy)
            flat, counts = encoder.encode(batch.column("text").to_pylist())
            ids = np.insert(flat, np.cumsum(counts), END_ID)
            rows = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(copies, pa.int64()), pa.array([shard] * len(copies), pa.int64()), pa.array(counts + 1, pa.int64())],
                ["doc_id", "copy", "shard", "n_tokens"],
            )
            writer.add(*_key_arrays(rows), ids, counts + 1)
            yield rows
        if writer is not None:
            writer.close()

    placed.mapInArrow(run, CATALOG).write.mode("overwrite").parquet(f"{root}/catalog")
    return read_catalog(spark, root)


def read_catalog(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(CATALOG).parquet(f"{root}/catalog")


def shard_sizes(catalog: DataFrame, root: str) -> DataFrame:
    """``shard, n``: ids in each shard, from the footers of the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [ShardReader(root, shard).n_ids for shard in batch.column("shard").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(counts, pa.int64())], ["shard", "n"])

    return catalog.select("shard").distinct().mapInArrow(run, "shard bigint, n bigint")


def shard_starts(sizes: DataFrame) -> DataFrame:
    """Ids in all shards before each shard, by sums over blocks of shards instead of one long window."""
    sums = sizes.withColumn("block", F.expr("shard div 1024"))
    before = lambda w, n: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = sums.groupBy("block").agg(F.sum("n").alias("block_n"))
    blocks = blocks.select("block", before(Window.orderBy("block"), "block_n").alias("block_start"))
    inside = sums.select("shard", "block", before(Window.partitionBy("block").orderBy("shard"), "n").alias("inside"))
    return inside.join(blocks, "block").select("shard", (F.col("block_start") + F.col("inside")).alias("shard_start"))


def read_documents(wanted: DataFrame, root: str) -> DataFrame:
    """Look up ``(doc_id, copy, shard)`` rows in their shard files by key.

    Returns ``doc_id, copy, shard, first, n_tokens, ids_crc32``; the last three are null for a
    key that its shard does not hold.  Rows of a shard should lie together, as in the catalog.
    """
    schema = "doc_id bigint, copy bigint, shard bigint, first bigint, n_tokens bigint, ids_crc32 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, reader = None, None
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            keys, copies = _key_arrays(batch)
            cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if shards[begin] != shard:
                    shard = int(shards[begin])
                    reader = ShardReader(root, shard)
                first, count = reader.find(keys[begin:end], copies[begin:end])
                crcs = [
                    zlib.crc32(reader.ids(f, n).astype("<u4").tobytes()) if f >= 0 else None
                    for f, n in zip(first.tolist(), count.tolist())
                ]
                part, absent = batch.slice(begin, end - begin), first < 0
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("copy"), part.column("shard"),
                        pa.array(first, pa.int64(), mask=absent), pa.array(count, pa.int64(), mask=absent), pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "copy", "shard", "first", "n_tokens", "ids_crc32"],
                )

    return wanted.select("doc_id", "copy", "shard").mapInArrow(run, schema)


def token_digests(documents: DataFrame, vocabulary_path: str) -> DataFrame:
    """Write all documents as token files, read them back by key, and return their digests."""
    root = f"{checkpoint_root(documents.sparkSession)}/token-files-{uuid.uuid4().hex}"
    catalog = write_token_files(documents, vocabulary_path, root)
    read = read_documents(catalog, root).join(shard_starts(durable(shard_sizes(catalog, root), "shard-sizes")), "shard")
    return read.select("doc_id", (F.col("shard_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
