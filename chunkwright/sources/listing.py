"""File trees as tables: tasks list the folders and read the files.

Neither names nor contents pass through the driver.  Every task lists the upper folders and owns, by a
hash of their paths, a share of what they hold; the folders below are walked by their owner alone.  Paths
are what pyarrow reaches: mounted folders, ``file:`` and the URIs of its file systems.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from chunkwright.session import durable

FORMAT = "file_listing"
LISTING = "relpath string, length bigint, modified timestamp"
# Folders less deep than this are listed by every task.
SHARED_LEVELS = 2
# Bytes of contents per task and per batch, and files per task.
TASK_BYTES, BATCH_BYTES, TASK_FILES = 64 << 20, 8 << 20, 10_000
_ROWS = 4096
# Bytes of a file that one task reads lines from at a time.
RANGE_BYTES = 32 << 20
# Files that Spark's readers pass over, and those that they decompress, by relative path.
HIDDEN = r"(^|/)([.]|_[^=/]*(/|$))|[.]_COPYING_(/|$)"
PACKED = r"(?i)[.](gz|bz2|deflate|snappy|lz4|zst|zstd)$"
# Tasks get the source with the job, so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it without a slash at its end."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    store, inside = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return store, inside.rstrip("/")


class Share(InputPartition):
    """One of ``of`` shares of the tree."""

    def __init__(self, number: int, of: int):
        self.number, self.of = number, of


class FileListingReader(DataSourceReader):
    def __init__(self, root: str, pattern: str, tasks: int):
        self.root, self.pattern, self.tasks = root, pattern, tasks

    def partitions(self) -> list[Share]:
        return [Share(i, self.tasks) for i in range(self.tasks)]

    def _files(self, share: Share) -> Iterator[tuple[str, fs.FileInfo]]:
        store, base = file_system(self.root)
        folders = [("", 0, False)]
        while folders:
            folder, level, owned = folders.pop()
            for info in store.get_file_info(fs.FileSelector(f"{base}/{folder}" if folder else base)):
                path = f"{folder}/{info.base_name}" if folder else info.base_name
                mine = owned or zlib.crc32(path.encode("utf-8", "surrogateescape")) % share.of == share.number
                if info.type == fs.FileType.Directory:
                    if mine or level + 1 < SHARED_LEVELS:
                        folders.append((path, level + 1, owned or mine and level + 1 >= SHARED_LEVELS))
                elif mine and fnmatchcase(info.base_name, self.pattern):
                    yield path, info

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        names, sizes, times = [], [], []

        def batch() -> pa.RecordBatch:
            columns = [pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(times, pa.timestamp("us", "UTC"))]
            return pa.RecordBatch.from_arrays(columns, ["relpath", "length", "modified"])

        for path, info in self._files(partition):
            names.append(path)
            sizes.append(info.size)
            times.append(None if info.mtime_ns is None else info.mtime_ns // 1000)
            if len(names) == _ROWS:
                yield batch()
                names, sizes, times = [], [], []
        if names:
            yield batch()


class FileListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> FileListingReader:
        return FileListingReader(self.options["path"], self.options.get("pattern", "*"), int(self.options.get("tasks", "8")))


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Files at any depth below ``root`` whose names match: ``(relpath, length, modified)``, in no order."""
    spark.dataSource.register(FileListing)
    tasks = 2 * spark.sparkContext.defaultParallelism
    return spark.read.format(FORMAT).option("path", root).option("pattern", pattern).option("tasks", tasks).load()


def read_files(files: DataFrame, root: str) -> DataFrame:
    """Add ``content``, the bytes of the files ``relpath`` below ``root``.

    The files are dealt evenly over tasks of bounded bytes and numbers, however they lie in folders.
    """
    spark = files.sparkSession
    listed = durable(files, "listing")
    total = listed.agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files")).first()
    cores = spark.sparkContext.defaultParallelism
    tasks = max(2 * cores, (total.bytes or 0) // TASK_BYTES + 1, total.files // TASK_FILES + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(root)
        for batch in batches:
            start, held, contents = 0, 0, []
            for at, path in enumerate(batch.column("relpath").to_pylist()):
                with store.open_input_stream(f"{base}/{path}") as file:
                    contents.append(file.read())
                held += len(contents[-1])
                if held >= BATCH_BYTES or at + 1 == batch.num_rows:
                    rows = batch.slice(start, at + 1 - start)
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(contents, pa.binary())], [*batch.schema.names, "content"])
                    start, held, contents = at + 1, 0, []

    return listed.repartition(int(tasks), "relpath").mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in files.schema)}, content binary")


def read_ranges(files: DataFrame, root: str) -> DataFrame:
    """The lines of the files ``relpath, length`` below ``root`` that hold a character: ``(relpath, value)``.

    Long files are read in ranges of bytes by several tasks.  A line belongs to the range it begins in and ends at
    ``\\n``, ``\\r`` or both.
    """
    spark = files.sparkSession
    starts = F.explode(F.expr(f"sequence(0L, greatest(length - 1, 0L), {RANGE_BYTES}L)"))
    ranges = durable(files.where("length > 0").select("relpath", "length", starts.alias("start")), "line-ranges")
    held = F.least("length", F.lit(RANGE_BYTES))
    total = ranges.agg(F.sum(held).alias("bytes"), F.count(F.lit(1)).alias("ranges")).first()
    cores = spark.sparkContext.defaultParallelism
    tasks = max(2 * cores, (total.bytes or 0) // TASK_BYTES + 1, total.ranges // TASK_FILES + 1)

    def lines_of(file, start: int) -> list[bytes]:
        """Lines that begin in the range; the byte before it tells whether one begins at its start."""
        file.seek(max(start - 1, 0))
        data = file.read(RANGE_BYTES + (start > 0))
        full = len(data) == RANGE_BYTES + (start > 0)
        if not start:
            data = data.removeprefix(b"\xef\xbb\xbf")
        parts = data.replace(b"\r", b"\n").split(b"\n")
        if start:
            # What stands before the first line end began in an earlier range.
            parts = parts[1:]
        # The last line goes on behind the range; one that would begin right behind it is the next range's.
        tail = []
        while full and parts and parts[-1]:
            more = file.read(1 << 16)
            rest = more.replace(b"\r", b"\n").split(b"\n", 1)
            tail.append(rest[0])
            if len(rest) > 1 or not more:
                break
        if tail:
            parts[-1] = b"".join([parts[-1], *tail])
        return [p for p in parts if p]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(root)
        names, values, size = [], [], 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], ["relpath", "value"])

        for batch in batches:
            for path, start in zip(*(batch.column(c).to_pylist() for c in ("relpath", "start"))):
                with store.open_input_file(f"{base}/{path}") as file:
                    found = lines_of(file, start)
                for value in found:
                    names.append(path)
                    values.append(value)
                    size += len(value)
                    if size >= BATCH_BYTES:
                        yield made()
                        names, values, size = [], [], 0
        if names:
            yield made()

    dealt = ranges.select("relpath", "start").repartition(int(tasks), "relpath", "start")
    # Bytes become text as they are, as with Spark's own reader.
    return dealt.mapInArrow(run, "relpath string, value binary").select("relpath", F.col("value").cast("string").alias("value"))
