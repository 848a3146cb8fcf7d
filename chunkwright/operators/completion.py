"""Run a request table through a user-supplied completion function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame

Complete = Callable[[list[dict], int], str | None]

# Fixed value: how often an empty reply is asked for.
MAX_ATTEMPTS = 3
REPLY_DDL = "request_id string, attempt int, status string, content string, error string"
# Requests of a task whose replies leave it together, per request under way at a time.
ROUNDS = 8


def complete(
    requests: DataFrame,
    fn: Complete,
    max_attempts: int = MAX_ATTEMPTS,
    concurrency: int = 1,
    wait_seconds: float = 0.0,
) -> DataFrame:
    """One reply row per request: ``(request_id, attempt, status, content, error)``.

    A task has up to ``concurrency`` requests under way and hands on replies after every few.
    Before asking again it waits ``wait_seconds``, twice as long each time.

    ``fn(messages, attempt)`` returns the reply text.  An empty or blank reply is asked
    for again; after the last attempt its status is ``empty``.  A raised exception ends
    the request with status ``failed`` and its message.  Replies may differ from call to
    call, so write the result (``session.durable``) before it is used twice.
    """

    if concurrency < 1 or max_attempts < 1:
        raise ValueError("concurrency and max_attempts must be positive")

    def ask(messages: list[dict]) -> tuple[int, str, str | None, str | None]:
        for attempt in range(1, max_attempts + 1):
            if attempt > 1 and wait_seconds:
                time.sleep(wait_seconds * 2 ** (attempt - 2))
            try:
                content = fn(messages, attempt)
            except Exception as exc:
                return attempt, "failed", None, f"{type(exc).__name__}: {exc}"
            if content and content.strip():
                return attempt, "ok", content, None
        return max_attempts, "empty", content, f"empty reply after {max_attempts} attempts"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                for start in range(0, batch.num_rows, ROUNDS * concurrency):
                    part = batch.slice(start, ROUNDS * concurrency)
                    answers = list(pool.map(ask, part.column("messages").to_pylist()))
                    attempt, status, content, error = zip(*answers)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("request_id").cast(pa.string()),
                            pa.array(attempt, pa.int32()),
                            pa.array(status, pa.string()),
                            pa.array(content, pa.string()),
                            pa.array(error, pa.string()),
                        ],
                        names=["request_id", "attempt", "status", "content", "error"],
                    )

    return requests.select("request_id", "messages").mapInArrow(run, REPLY_DDL)
