"""Verify replies as they land, with the same column functions as the batch stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chunkwright.operators import checks, outcomes, replies
from chunkwright.session import configure

REPLY_LINES_DDL = (
    "chunk_id STRING, project STRING, file_path STRING, file_name STRING, chunk_index INT, content STRING"
)


def verify_stream(
    spark: SparkSession, landing: str, output: str, checkpoint: str, created_at: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Follow JSON lines of replies in ``landing`` and route items by their local checks.

    The stream's checkpoint takes the place of resuming.  Every batch writes folders of its
    own in overwrite mode, so a batch that is run again replaces what it wrote before.
    """
    configure(spark)
    landed = (
        spark.readStream.schema(REPLY_LINES_DDL).option("maxFilesPerTrigger", files_per_batch).json(landing)
    )

    def route(batch: DataFrame, batch_id: int) -> None:
        parsed = replies.parse_replies(batch)
        items = replies.build_items(replies.reply_elements(parsed), created_at)
        reported = checks.merge_verdicts(checks.local_checks(items), None, created_at).persist()
        try:
            for name, table in (
                ("verified", outcomes.verified_items(reported)),
                ("rejected", outcomes.rejected_items(reported)),
                ("failed", replies.failed_replies(parsed)),
            ):
                table.write.mode("overwrite").json(f"{output}/{name}/batch={batch_id}")
        finally:
            reported.unpersist()

    return (
        landed.writeStream.foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
