"""Stage two: chunks to verified and rejected items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.operators import checks, outcomes, replies
from chunkwright.operators.completion import MAX_ATTEMPTS, Complete, complete
from chunkwright.operators.prompts import (
    GENERATION_SYSTEM, GENERATION_USER, VERIFICATION_SYSTEM, VERIFICATION_USER, generation_requests, verification_requests,
)
from chunkwright.operators.requests import pending_chunks
from chunkwright.session import configure, durable
from chunkwright.sources.jsonl import read_chunks
from chunkwright.sources.runs import CHUNK_OF, commit_run, current_lines

CHUNK_KEYS = ["chunk_id", "project", "file_path", "file_name", "chunk_index"]


@dataclass(frozen=True)
class RunOptions:
    """What a run asks for and how; the prompts are templates (``functions.templates``)."""

    items_per_chunk: int = 2
    generation_system: str = GENERATION_SYSTEM
    generation_template: str = GENERATION_USER
    verification_system: str = VERIFICATION_SYSTEM
    verification_template: str = VERIFICATION_USER
    # System prompt and metadata of the items made.
    item_system: str = GENERATION_SYSTEM
    defaults: Mapping[str, object] = field(default_factory=dict)
    checks: Sequence[str] | None = None
    fail_open: bool = True
    max_attempts: int = MAX_ATTEMPTS
    concurrency: int = 1
    wait_seconds: float = 0.0
    parallelism: int | None = None
    save_rejected: bool = True


@dataclass
class RunTables:
    """Results of a run, all read back from written files."""

    items: DataFrame
    reported: DataFrame
    parsed: DataFrame
    stats: DataFrame
    failed: DataFrame


def generate_and_verify(
    chunks: DataFrame,
    generate: Complete,
    verify: Complete | None,
    created_at: str | Column,
    options: RunOptions = RunOptions(),
) -> RunTables:
    """Ask for items of every chunk, check them, and have clean items judged.

    Replies are written before they are read, so no reply is asked for twice.  Only items
    without a local error reach ``verify``; without ``verify`` local checks decide.
    """
    o = options

    def ask(requests: DataFrame, fn: Complete, name: str) -> DataFrame:
        lanes = requests.repartition(o.parallelism, "request_id") if o.parallelism else requests
        return durable(complete(lanes, fn, o.max_attempts, o.concurrency, o.wait_seconds), name)

    wanted = generation_requests(chunks, o.items_per_chunk, o.generation_system, o.generation_template)
    answered = ask(wanted, generate, "replies")
    with_chunk = answered.withColumnRenamed("request_id", "chunk_id").join(chunks.select(*CHUNK_KEYS), "chunk_id")
    parsed = replies.parse_replies(with_chunk.select(*CHUNK_KEYS, "content"))
    items = replies.build_items(replies.reply_elements(parsed), created_at, o.item_system, o.defaults)
    checked = durable(checks.local_checks(items, o.checks), "checked")
    verdicts = None
    if verify is not None:
        requests = verification_requests(
            checks.needs_verdict(checked), chunks, o.verification_system, o.verification_template
        )
        verdicts = checks.read_verdicts(ask(requests, verify, "verdicts"))
    reported = durable(checks.merge_verdicts(checked, verdicts, created_at, o.fail_open), "reported")
    return RunTables(
        items=checked.select(*checks.ITEM_FIELDS),
        reported=reported,
        parsed=parsed,
        stats=outcomes.chunk_stats(chunks, reported),
        failed=outcomes.failed_chunks(chunks, answered, parsed),
    )


def run_workspace(
    spark: SparkSession,
    workspace: str,
    generate: Complete,
    verify: Complete | None,
    created_at: str,
    resume: bool = False,
    options: RunOptions = RunOptions(),
) -> DataFrame:
    """Read ``workspace/chunks``, write the result tables of a run, return its totals.

    ``resume`` asks only for chunks without a current verified item, and its rows replace
    those of earlier runs for the same chunks; otherwise earlier runs no longer count.
    Read results with ``sources.runs.current_lines``: a run counts once all its tables are there.
    """
    configure(spark)
    chunks = read_chunks(spark, f"{workspace}/chunks")
    if resume:
        chunk_id = F.get_json_object("value", CHUNK_OF["verified"]).alias("chunk_id")
        chunks = pending_chunks(chunks, current_lines(spark, workspace, "verified").select(F.struct(chunk_id).alias("metadata")))
    chunks = durable(chunks, "chunks")
    run = generate_and_verify(chunks, generate, verify, created_at, options)
    rejected = outcomes.rejected_items(run.reported)
    tables = {
        "generations": run.items,
        "verified": outcomes.verified_items(run.reported),
        "rejected": rejected if options.save_rejected else rejected.limit(0),
        "failed_chunks": run.failed,
        "failed_replies": replies.failed_replies(run.parsed).select(F.struct("*").alias("reply")),
    }
    commit_run(chunks, tables, workspace, fresh=not resume)
    return outcomes.run_totals(run.stats)
