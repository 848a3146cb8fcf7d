"""Sink that writes rows ``(file, value)`` as the lines of files with exactly these names.

Tasks write into folders of their own below ``.staged``.  The write commits when the driver puts one marker
beside them; from then on tasks move the files into place.  Moving may be repeated: where the driver
is lost in between, ``finish_writes``, or the next write to the folder, ends it.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from chunkwright.session import durable
from chunkwright.sources.listing import file_system, list_files

FORMAT = "named_lines"
STAGED = ".staged"
MARKER = "committed.json"
# Tasks get the sink with the job, so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Written(WriterCommitMessage):
    folder: str


class NamedLinesWriter(DataSourceArrowWriter):
    """Each task writes whole files: rows of one file stand together in one partition.

    Each attempt of a task has a folder of its own; the marker names those that count.
    """

    def __init__(self, path: str, overwrite: bool, replace: list[str]):
        self.path, self.replace = path, replace
        self.staging = f"{STAGED}/{uuid.uuid4().hex}"
        target, root = file_system(path)
        there = target.get_file_info(root).type != fs.FileType.NotFound
        if there and not overwrite and target.get_file_info(fs.FileSelector(root)):
            raise ValueError(f"{path} exists and is not empty")
        target.create_dir(root, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        target, root = file_system(self.path)
        folder, current, out = uuid.uuid4().hex, None, None
        for batch in iterator:
            names, values = batch.column("file"), batch.column("value")
            runs = pc.run_end_encode(names) if len(names) else None
            start = 0
            for run, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()) if runs else ():
                if run != current:
                    if out is not None:
                        out.close()
                    current = run
                    path = f"{root}/{self.staging}/{folder}/{run}"
                    target.create_dir(path.rpartition("/")[0], recursive=True)
                    out = target.open_output_stream(path)
                lines = values.slice(start, end - start).to_pylist()
                out.write(("\n".join(lines) + "\n").encode("utf-8"))
                start = end
        if out is not None:
            out.close()
        return Written(folder)

    def commit(self, messages) -> None:
        target, root = file_system(self.path)
        what = {"folders": [m.folder for m in messages if m], "replace": self.replace}
        target.create_dir(f"{root}/{self.staging}", recursive=True)
        with target.open_output_stream(f"{root}/{self.staging}/{MARKER}.new") as out:
            out.write(json.dumps(what).encode("utf-8"))
        target.move(f"{root}/{self.staging}/{MARKER}.new", f"{root}/{self.staging}/{MARKER}")

    def abort(self, messages) -> None:
        target, root = file_system(self.path)
        if target.get_file_info(f"{root}/{self.staging}").type != fs.FileType.NotFound:
            target.delete_dir(f"{root}/{self.staging}")


def _exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


def _move(staged: DataFrame, path: str, staging: str) -> DataFrame:
    """The names of staged files ``(folder, name)``, moved into place by the tasks; a file moved before stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(path)
        made = set()
        for batch in batches:
            for folder, name in zip(*(batch.column(c).to_pylist() for c in ("folder", "name"))):
                source, target = f"{root}/{staging}/{folder}/{name}", f"{root}/{name}"
                parent = target.rpartition("/")[0]
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                if _exists(store, source):
                    store.move(source, target)
                elif not _exists(store, target):
                    raise FileNotFoundError(source)
            yield pa.RecordBatch.from_arrays([batch.column("name")], ["name"])

    return staged.mapInArrow(run, "name string")


def _delete(names: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(path)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                if _exists(store, f"{root}/{name}"):
                    store.delete_file(f"{root}/{name}")
            yield batch

    return names.mapInArrow(run, "name string")


def finish_writes(spark: SparkSession, path: str) -> None:
    """Move the files of committed writes into place and clear what uncommitted ones have left.

    The driver reads one marker per write, which names a folder per task; names of files stay in the tasks.
    """
    store, root = file_system(path)
    for write in store.get_file_info(fs.FileSelector(f"{root}/{STAGED}", allow_not_found=True)):
        staging = f"{STAGED}/{write.base_name}"
        if _exists(store, f"{root}/{staging}/{MARKER}"):
            with store.open_input_stream(f"{root}/{staging}/{MARKER}") as file:
                what = json.loads(file.read())
            moved = durable(_move(_staged(spark, path, staging, what["folders"]), path, staging), "published")
            for folder in what["replace"]:
                if _exists(store, f"{root}/{folder}"):
                    there = list_files(spark, f"{path.rstrip('/')}/{folder}").where("relpath NOT LIKE '%/%'")
                    stale = there.select(F.concat(F.lit(f"{folder}/"), "relpath").alias("name")).join(moved, "name", "left_anti")
                    _delete(stale, path).count()
        store.delete_dir(f"{root}/{staging}")
    if _exists(store, f"{root}/{STAGED}"):
        store.delete_dir(f"{root}/{STAGED}")


def _staged(spark: SparkSession, path: str, staging: str, folders: Sequence[str]) -> DataFrame:
    """``folder, name`` of the files that the tasks which count have written.

    They are written down beside the marker before the first file moves, so that what an interrupted
    move has placed already still counts as a name of this write.
    """
    store, root = file_system(path)
    base = f"{path.rstrip('/')}/{staging}"
    if not _exists(store, f"{root}/{staging}/names/_SUCCESS"):
        found = list_files(spark, base).where("relpath LIKE '%/%'")
        parts = found.select(F.substring_index("relpath", "/", 1).alias("folder"), F.expr("substr(relpath, instr(relpath, '/') + 1)").alias("name"))
        counted = spark.createDataFrame([(f,) for f in folders], "folder string")
        parts.join(F.broadcast(counted), "folder").write.mode("overwrite").parquet(f"{base}/names")
    return spark.read.schema("folder string, name string").parquet(f"{base}/names")


class NamedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> NamedLinesWriter:
        return NamedLinesWriter(self.options["path"], overwrite, json.loads(self.options.get("replace", "[]")))


def write_named_lines(
    df: DataFrame, path: str, order: str | None = None, overwrite: bool = True, replace: Sequence[str] = ()
) -> None:
    """Write ``(file, value)`` rows; ``order`` names the column that orders the lines of a file.

    ``path`` is a folder all executors share: a mounted path or a file system URI.  File names
    may hold folders.  Existing files of the same names are replaced, others are left alone
    but for those in the folders ``replace`` names; without ``overwrite`` the folder must be empty.
    One write at a time goes to a folder.
    """
    spark = df.sparkSession
    spark.dataSource.register(NamedLines)
    finish_writes(spark, path)
    placed = df.repartition("file").sortWithinPartitions("file", *([order] if order else []))
    rows = placed.select("file", "value")
    writer = rows.write.format(FORMAT).mode("overwrite" if overwrite else "append")
    writer.option("path", path).option("replace", json.dumps(list(replace))).save()
    finish_writes(spark, path)
