"""Progress of chunks, kept per chunk while replies and verdicts land in any order.

A chunk's reply names its items; every item gets a verdict of its own.  Replies come again with a higher
attempt, events come twice or late, and verdicts may come before the reply they belong to or never.  The state
of a chunk holds its newest reply and the verdicts so far.  A chunk closes once: when every item has its
verdict, or when its patience has run out on the event clock, and then items without a verdict count as passed, as
they do in batch.  What comes later is ignored.  The stream's checkpoint holds the state, so a restart goes on where it was.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

EVENTS_DDL = "chunk_id STRING, kind STRING, attempt INT, items ARRAY<STRING>, item STRING, passed BOOLEAN, at TIMESTAMP"
PROGRESS_DDL = "chunk_id STRING, attempt INT, status STRING, generated INT, verified INT, rejected INT, missing INT"
_REPLY = "attempt INT, items ARRAY<STRING>, seen BIGINT, closed BOOLEAN"
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def outcome(attempt: int, items: list[str], verdicts: dict[str, bool]) -> dict:
    """What is known of a chunk with these items."""
    missing = sum(i not in verdicts for i in items)
    rejected = sum(verdicts.get(i) is False for i in items)
    status = "failed" if not items else "open" if missing else "done"
    return {
        "attempt": attempt, "status": status, "generated": len(items), "verified": len(items) - rejected, "rejected": rejected, "missing": missing,
    }


class ChunkProgress(StatefulProcessor):
    """The state of one chunk: its newest reply, its verdicts, and whether it is closed."""

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.reply = handle.getValueState("reply", _REPLY)
        self.verdicts = handle.getMapState("verdicts", "item STRING", "passed BOOLEAN")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        attempt, items, seen, closed = self.reply.get() if self.reply.exists() else (0, None, 0, False)
        for row in rows:
            if closed:
                break
            seen = max(seen, int(row["at"].timestamp() * 1000))
            if row["kind"] == "verdict":
                self.verdicts.updateValue((row["item"],), (bool(row["passed"]),))
            elif row["attempt"] > attempt:
                attempt, items = row["attempt"], list(row["items"] or [])
        if closed:
            return
        told = None
        if items:
            known = {i: self.verdicts.getValue((i,))[0] for i in items if self.verdicts.containsKey((i,))}
            if len(known) == len(set(items)):
                told, closed = outcome(attempt, items, known), True
        self.reply.update((attempt, items, seen, closed))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(seen + self.patience_ms)
        if told:
            yield Row(chunk_id=key[0], **told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        attempt, items, _, closed = self.reply.get()
        if not closed:
            known = {i: self.verdicts.getValue((i,))[0] for i in items or [] if self.verdicts.containsKey((i,))}
            self.reply.update((attempt, items, 0, True))
            yield Row(chunk_id=key[0], **outcome(attempt, items or [], known))
        # The verdicts of a closed chunk are not asked for again; the mark that it is closed stays.
        self.verdicts.clear()

    def close(self) -> None:
        pass


def follow_progress(
    spark: SparkSession, landing: str, output: str, checkpoint: str, patience: int = 3600, files_per_batch: int = 1000
) -> StreamingQuery:
    """Append one row per closed chunk to the Parquet folder ``output``, from JSON lines of events in ``landing``.

    ``patience`` is in seconds, for events that come late and for verdicts that do not come.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    events = spark.readStream.schema(EVENTS_DDL).option("maxFilesPerTrigger", files_per_batch).json(landing)
    closed = (
        events.withWatermark("at", f"{patience} seconds")
        .groupBy("chunk_id")
        .transformWithState(
            statefulProcessor=ChunkProgress(1000 * patience), outputStructType=StructType.fromDDL(PROGRESS_DDL), outputMode="append", timeMode="EventTime"
        )
    )
    return closed.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress_of(events: DataFrame) -> DataFrame:
    """What the stream tells of chunks when all of their events have come in time."""
    newest = Window.partitionBy("chunk_id").orderBy(F.col("attempt").desc())
    replies = events.where("kind = 'reply'").dropDuplicates(["chunk_id", "attempt"])
    replies = replies.withColumn("_n", F.row_number().over(newest)).where("_n = 1").select("chunk_id", "attempt", F.coalesce("items", F.array()).alias("items"))
    verdicts = events.where("kind = 'verdict'").groupBy("chunk_id", "item").agg(F.max_by("passed", "at").alias("passed"))
    judged = replies.select("chunk_id", F.explode("items").alias("item")).join(verdicts, ["chunk_id", "item"], "left")
    counts = judged.groupBy("chunk_id").agg(
        F.sum(F.when(~F.col("passed"), 1).otherwise(0)).alias("rejected"), F.sum(F.when(F.col("passed").isNull(), 1).otherwise(0)).alias("missing")
    )
    none = lambda c: F.coalesce(c, F.lit(0)).cast("int")
    generated = F.size("items")
    status = F.when(generated == 0, "failed").when(none("missing") > 0, "open").otherwise("done")
    return replies.join(counts, "chunk_id", "left").select(
        "chunk_id", "attempt", status.alias("status"), generated.alias("generated"), (generated - none("rejected")).alias("verified"),
        none("rejected").alias("rejected"), none("missing").alias("missing"),
    )
