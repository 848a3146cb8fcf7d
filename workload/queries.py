"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.functions import ids, jsonfix, jsonscan, tokens
from chunkwright.operators import audit, blocks, checks, chunking, completion, outcomes, packing, permutation, prompts, replies, requests, schedule
from chunkwright.operators.validation import file_errors as errors_of_lines, file_report as report_of_files, validate, validate_json
from chunkwright.schemas import CHUNK_DDL
from chunkwright.session import durable, once
from chunkwright.sources import jsonl, markdown
from chunkwright.sources.shards import write_named_lines
from chunkwright.streaming import progress
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CHUNK_SHAPE = [
    "chunk_id", "project", "file_path", "file_name", "chunk_index", "total_chunks", "token_start", "token_end",
    "text", "metadata.file_sha1",
]
THREE = {"train": 0.8, "val": 0.1, "test": 0.1}
UNSCALED = {"a": 2, "b": 1, "c": 1}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _joined(column: str = "errors", by: str = ",") -> Column:
    return F.array_join(column, by).alias("errors")


# --- sources and sinks -----------------------------------------------------------


@query
def discovered_projects(spark, sf_dir):
    return markdown.discover_projects(spark, fx.markdown_folder(spark, sf_dir))


@query
def found_files(spark, sf_dir):
    found = markdown.find_files(spark, fx.markdown_folder(spark, sf_dir))
    return found.select("relpath", "length", F.length("content").cast("bigint").alias("read"))


@query
def markdown_documents(spark, sf_dir):
    read = markdown.read_markdown(spark, fx.markdown_folder(spark, sf_dir))
    return read.select("project", "file_path", "file_name", ids.sha256_hash(F.col("text")).alias("text_hash"), "file_sha1")


@query
def chunk_files(spark, sf_dir):
    folder = fx.shared_folder(spark, "chunk-files")
    jsonl.write_chunks(fx.chunks(spark, sf_dir), folder)
    return jsonl.read_chunks(spark, folder).select(*CHUNK_SHAPE)


@query
def chunk_lines_read(spark, sf_dir):
    """Lines of a folder read one by one: typed fields, and whether the line is malformed."""
    folder = fx.lines_folder(fx.chunk_lines(spark, sf_dir), "chunk-lines")
    read = jsonl.read_jsonl(spark, folder, CHUNK_DDL, strict=False)
    return read.groupBy(F.col("_corrupt_record").isNotNull().alias("malformed")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("token_end").alias("token_ends")
    )


@query
def line_counts(spark, sf_dir):
    folder = fx.lines_folder(fx.chunk_lines(spark, sf_dir), "chunk-lines")
    counted = jsonl.count_lines(spark, folder)
    return counted.select(F.regexp_extract("file", "([^/]+)[.]md[.]chunks[.]jsonl$", 1).cast("bigint").alias("doc_id"), "lines")


@query
def collected_items(spark, sf_dir):
    """Item lines of a folder, checked; a bad line costs no other."""
    items = fx.conversation_items(spark, sf_dir, faults=True)
    record = F.to_json(F.struct(*[c for c in items.columns if c not in ("conv_id", "turn")]))
    lines = items.select(F.concat(F.lit("run/"), F.col("conv_id") % 16, F.lit(".jsonl")).alias("file"), F.struct("conv_id", "turn").alias("line"), record.alias("value"))
    read = jsonl.read_verified(spark, fx.lines_folder(lines, "items"))
    return read.groupBy(_joined(by="; "), "valid").agg(F.count(F.lit(1)).alias("items"), F.countDistinct("id").alias("ids"))


@query
def named_files(spark, sf_dir):
    """Shards written under their exact names and read back with line numbers."""
    folder = fx.shared_folder(spark, "shards")
    lines = _sharded(spark, sf_dir).select(F.concat(F.lit("shards/"), "file").alias("file"), "rank_in_split", F.col("chunk_id").alias("value"))
    write_named_lines(lines, folder, order="rank_in_split")
    read = jsonl.numbered_lines(spark, folder)
    return read.select(F.regexp_extract("file", "([^/]+)$", 1).alias("file"), "line", F.col("value").alias("chunk_id"))


# --- identifiers and tokens ------------------------------------------------------


@query
def ids_hashes(spark, sf_dir):
    docs = fx.documents(spark, sf_dir)
    chunk = ids.chunk_id(F.col("project"), F.col("file_path"), F.lit(0), F.col("file_sha1"))
    item = ids.stable_uuid(F.col("file_path"), F.lit(0))
    run = ids.run_id(F.timestamp_seconds(1700000000 + F.col("doc_id") * 3607))
    return docs.select(
        "doc_id",
        ids.sha256_hash(F.col("text")).alias("text_hash"),
        "file_sha1",
        chunk.alias("chunk_id"),
        item.alias("item_id"),
        ids.is_valid_uuid(item).alias("item_id_ok"),
        ids.is_valid_uuid(chunk).alias("hash_is_id"),
        run.alias("run_id"),
        ids.is_valid_run_id(run).alias("run_id_ok"),
    )


@query
def token_counts(spark, sf_dir):
    return fx.raw_documents(spark, sf_dir).select("doc_id", tokens.count_tokens(F.col("text")).alias("tokens"))


def _vocabulary() -> str:
    """The name of a public byte-level vocabulary as tokenizer."""
    import public_tokenizers

    return f"vocabulary:file={public_tokenizers.path('byte_bpe_50k.json')}"


@query
def vocabulary_tokens(spark, sf_dir):
    """Numbers of vocabulary tokens, whether they decode to their text, and their ends in characters as a digest."""
    tokenizer = tokens.get_tokenizer(_vocabulary())
    encoded = fx.documents(spark, sf_dir).select("doc_id", "text", tokenizer.encode(F.col("text")).alias("ids"))
    # A function of another's result would run that one anew; not so across `once`.
    encoded = once(encoded, {"ids": F.col("ids")})
    docs = encoded.select("*", tokenizer.token_ends(F.col("text"), F.col("ids")).alias("ends"))
    return docs.select(
        "doc_id", F.size("ids").alias("tokens"), (tokenizer.decode(F.col("ids")) == F.col("text")).alias("same"),
        F.sha2(F.array_join(F.col("ends").cast("array<string>"), ","), 256).alias("ends_sha256"),
    )


@query
def chunks_of_vocabulary_tokens(spark, sf_dir):
    options = chunking.ChunkOptions(max_tokens=256, overlap=32, tolerance_pct=10, tokenizer=_vocabulary())
    return fx.chunks(spark, sf_dir, options).select(*CHUNK_SHAPE)


@query
def token_roundtrip(spark, sf_dir):
    docs = fx.documents(spark, sf_dir).select("doc_id", "text", tokens.encode(F.col("text")).alias("tk"))
    return docs.select(
        "doc_id",
        (tokens.decode(F.col("tk")) == F.col("text")).alias("same"),
        tokens.decode(F.col("tk"), 3, 10).alias("part"),
    )


# --- chunking --------------------------------------------------------------------


@query
def semantic_breaks(spark, sf_dir):
    return fx.documents(spark, sf_dir).select(
        "doc_id", F.explode_outer(chunking.semantic_breaks(F.col("text"))).alias("break_at")
    ).where("break_at IS NOT NULL")


@query
def chunks(spark, sf_dir):
    return fx.chunks(spark, sf_dir).select(*CHUNK_SHAPE)


@query
def chunks_shipped_size(spark, sf_dir):
    return fx.chunks(spark, sf_dir, fx.SHIPPED).select(*CHUNK_SHAPE)


@query
def chunks_without_breaks(spark, sf_dir):
    return fx.chunks(spark, sf_dir, fx.PLAIN).select(*CHUNK_SHAPE)


@query
def chunks_in_blocks(spark, sf_dir):
    """Every text cut as if it were too long for one task."""
    made = blocks.chunk_large_documents(fx.documents(spark, sf_dir), fx.SMALL, fx.STAMP, block_chars=1500)
    return made.select(*CHUNK_SHAPE)


@query
def chunk_overlap(spark, sf_dir):
    made = fx.chunks(spark, sf_dir).select("project", "file_path", "chunk_index", "chunk_id", "token_start", "token_end", "text")
    nxt = made.select(
        "project",
        "file_path",
        (F.col("chunk_index") - 1).alias("chunk_index"),
        F.col("chunk_id").alias("next_id"),
        F.col("token_start").alias("next_start"),
        tokens.decode(F.slice(tokens.encode(F.col("text")), 1, fx.SMALL.overlap)).alias("next_text"),
    )
    return made.join(nxt, ["project", "file_path", "chunk_index"]).select(
        "chunk_id",
        "next_id",
        (F.col("token_end") - F.col("next_start")).alias("overlap_tokens"),
        F.endswith("text", "next_text").alias("same_text"),
    )


@query
def chunk_stats(spark, sf_dir):
    return chunking.project_stats(fx.documents(spark, sf_dir), fx.chunks(spark, sf_dir))


@query
def corpus_totals(spark, sf_dir):
    return chunking.corpus_totals(chunk_stats(spark, sf_dir))


@query
def chunk_validation(spark, sf_dir):
    made = fx.chunks(spark, sf_dir)
    fault = F.expr(f"{fx.DOC_ID} % 7")
    wrong = made.select(
        F.when(fault == 1, "bad").otherwise(F.col("chunk_id")).alias("chunk_id"),
        F.when(fault == 2, "").otherwise(F.col("project")).alias("project"),
        "file_path",
        "file_name",
        F.when(fault == 3, -1 - F.col("chunk_index")).otherwise(F.col("chunk_index")).alias("chunk_index"),
        "total_chunks",
        "token_start",
        "token_end",
        F.when(fault != 6, F.col("text")).alias("text"),
        F.col("metadata")
        .withField("source_format", F.when(fault == 4, "html").otherwise(F.col("metadata.source_format")))
        .withField("file_sha1", F.when(fault == 5, "xyz").otherwise(F.col("metadata.file_sha1")))
        .alias("metadata"),
    )
    index = F.when(F.col("chunk_index") < 0, -1 - F.col("chunk_index")).otherwise(F.col("chunk_index"))
    return validate(wrong, "chunk").select("file_path", index.alias("chunk_index"), _joined(by="; "), "valid")


# --- requests --------------------------------------------------------------------


@query
def gen_requests(spark, sf_dir):
    return prompts.generation_requests(fx.chunks(spark, sf_dir)).select(
        "request_id",
        F.col("messages")[0]["content"].alias("system_content"),
        F.col("messages")[1]["content"].alias("user_content"),
    )


@query
def verify_requests(spark, sf_dir):
    made = fx.stored_chunks(spark, sf_dir)
    asked = prompts.verification_requests(checks.needs_verdict(fx.checked_items(made)), made)
    return asked.select("request_id", F.col("messages")[1]["content"].alias("user_content"))


@query
def request_token_estimate(spark, sf_dir):
    made = prompts.generation_requests(fx.chunks(spark, sf_dir))
    return made.select("request_id", requests.token_estimate(F.col("messages")).alias("estimate"))


def _document_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.raw_documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("request_id"),
        F.col("source").alias("lane"),
        prompts.messages("Answer the text", F.col("text")).alias("messages"),
    )


@query
def request_plan(spark, sf_dir):
    return requests.request_plan(
        _document_requests(spark, sf_dir), max_tokens=256, requests_per_minute=5, tokens_per_minute=3000, lane="lane"
    )


@query
def request_schedule(spark, sf_dir):
    return schedule.request_schedule(
        _document_requests(spark, sf_dir), max_tokens=256, requests_per_minute=5, tokens_per_minute=3000, lane="lane"
    )


@query
def completions(spark, sf_dir):
    def stub_model(messages: list[dict], attempt: int) -> str:
        """A deterministic stand-in: needs up to four attempts, and fails for some lengths."""
        n = len(messages[1]["content"])
        if n % 13 == 0:
            raise ValueError("no answer")
        return f"length {n}" if attempt > n % 4 else " "

    return completion.complete(_document_requests(spark, sf_dir), stub_model)


@query
def pending_chunks(spark, sf_dir):
    made = fx.stored_chunks(spark, sf_dir)
    verified = outcomes.verified_items(fx.reported_items(spark, sf_dir, made))
    left = requests.pending_chunks(made, verified)
    return left.select("chunk_id", "file_path", "chunk_index")


# --- replies ---------------------------------------------------------------------


@query
def extract_fence(spark, sf_dir):
    return fx.chunk_replies(fx.chunks(spark, sf_dir)).select("chunk_id", jsonfix.extract_fenced(F.col("content")).alias("extracted"))


@query
def sanitize_escapes(spark, sf_dir):
    return fx.chunk_replies(fx.chunks(spark, sf_dir)).select("chunk_id", jsonfix.repair_escapes(F.col("content")).alias("sanitized"))


@query
def strip_commas(spark, sf_dir):
    return fx.chunk_replies(fx.chunks(spark, sf_dir)).select(
        "chunk_id", jsonfix.drop_trailing_commas(F.col("content")).alias("stripped")
    )


@query
def json_validity(spark, sf_dir):
    return fx.chunk_replies(fx.chunks(spark, sf_dir)).select("chunk_id", jsonfix.json_problem(F.col("content")).alias("problem"))


@query
def json_faults(spark, sf_dir):
    replied = fx.chunk_replies(fx.chunks(spark, sf_dir)).select("chunk_id", jsonscan.json_fault(F.col("content")).alias("fault"))
    return replied.where("fault IS NOT NULL").select("chunk_id", "fault.*")


@query
def parse_robust(spark, sf_dir):
    elements = replies.reply_elements(fx.parsed_replies(fx.chunks(spark, sf_dir)))
    return elements.select("chunk_id", "position", "problem", "solution", "problem_is_text")


@query
def parse_stage_stats(spark, sf_dir):
    return replies.stage_stats(fx.parsed_replies(fx.chunks(spark, sf_dir)))


@query
def failed_replies(spark, sf_dir):
    return replies.failed_replies(fx.parsed_replies(fx.chunks(spark, sf_dir))).select(
        "chunk_id", "failure", "raw", "extracted", "sanitized", "json", "content_length"
    )


@query
def failed_chunks(spark, sf_dir):
    made = fx.stored_chunks(spark, sf_dir)
    content = fx.chunk_replies(made).select("chunk_id", "content")
    blank = F.trim(F.regexp_replace("content", r"\s", "")) == ""
    answered = content.select(
        F.col("chunk_id").alias("request_id"),
        F.when(blank, "empty").otherwise("ok").alias("status"),
        F.when(blank, "empty reply after 3 attempts").alias("error"),
    )
    return outcomes.failed_chunks(made, answered, fx.parsed_replies(made))


@query
def items(spark, sf_dir):
    return fx.items(fx.chunks(spark, sf_dir)).select(
        "id",
        F.col("metadata.chunk_id").alias("chunk_id"),
        *[F.col(f"metadata.{c}").alias(c) for c in ("project", "file_path", "file_name", "chunk_index")],
        "problem",
        "solution",
        F.col("messages")[0]["content"].alias("user_content"),
        F.col("messages")[1]["content"].alias("assistant_content"),
        "system_prompt",
        *[F.col(f"metadata.{c}").alias(c) for c in ("source", "difficulty", "subject")],
        F.size("metadata.tags").alias("tags"),
    )


# --- checks and outcomes ---------------------------------------------------------


@query
def local_checks(spark, sf_dir):
    return fx.checked_items(fx.chunks(spark, sf_dir)).select("id", "checks.*")


@query
def check_errors(spark, sf_dir):
    return fx.checked_items(fx.chunks(spark, sf_dir)).select("id", _joined())


def _reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.reported_items(spark, sf_dir, fx.stored_chunks(spark, sf_dir))


@query
def verdict_merge(spark, sf_dir):
    return _reported(spark, sf_dir).select(
        "id", F.col("metadata.chunk_id").alias("chunk_id"), "passed", _joined("verify_report.errors")
    )


@query
def verified_items(spark, sf_dir):
    return outcomes.verified_items(_reported(spark, sf_dir)).select(
        "id", F.col("metadata.chunk_id").alias("chunk_id"), "problem", "solution"
    )


@query
def rejected_items(spark, sf_dir):
    rejected = outcomes.rejected_items(_reported(spark, sf_dir))
    return rejected.select(
        F.col("item.id").alias("id"),
        F.col("verify_report.chunk_id").alias("chunk_id"),
        F.col("item.problem").alias("problem"),
        F.col("item.solution").alias("solution"),
        _joined("verify_report.errors"),
    )


@query
def chunk_item_stats(spark, sf_dir):
    made = fx.stored_chunks(spark, sf_dir)
    return outcomes.chunk_stats(made, fx.reported_items(spark, sf_dir, made))


@query
def run_totals(spark, sf_dir):
    return outcomes.run_totals(chunk_item_stats(spark, sf_dir))


@query
def first_failed_chunks(spark, sf_dir):
    return outcomes.first_failed_chunks(chunk_item_stats(spark, sf_dir))


@query
def error_histogram(spark, sf_dir):
    return outcomes.error_histogram(_reported(spark, sf_dir))


@query
def report_validation(spark, sf_dir):
    reported = _reported(spark, sf_dir)
    fault = F.expr("CAST(replace(metadata.file_name, '.md', '') AS BIGINT) % 4")
    report = reported.select(
        "id",
        F.when(fault == 0, F.upper("verify_report.input_item_id"))
        .otherwise(F.col("verify_report.input_item_id"))
        .alias("input_item_id"),
        "verify_report.chunk_id",
        F.when(fault != 2, F.col("verify_report.passed")).alias("passed"),
        F.when(fault == 1, F.concat("verify_report.errors", F.array(F.lit(""))))
        .otherwise(F.col("verify_report.errors"))
        .alias("errors"),
        "verify_report.checks",
        "verify_report.created_at",
    )
    fields = [c for c in report.columns if c != "id"]
    return validate(report, "report", fields).select("id", _joined(by="; "), "valid")


@query
def item_validation(spark, sf_dir):
    made = fx.conversation_items(spark, sf_dir, faults=True)
    return validate(made, "item", checks.ITEM_FIELDS).select("conv_id", "turn", _joined(by="; "), "valid")


@query
def conversation_items(spark, sf_dir):
    return fx.conversation_items(spark, sf_dir).select("conv_id", "turn", "id", "problem", "solution")


# --- audit -----------------------------------------------------------------------


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_lines(fx.chunk_lines(spark, sf_dir))


@query
def chunk_audit_by_file(spark, sf_dir):
    return audit.audit_by_file(_audited(spark, sf_dir))


@query
def chunk_audit_by_project(spark, sf_dir):
    return audit.audit_by_project(_audited(spark, sf_dir))


@query
def chunk_readiness(spark, sf_dir):
    return audit.audit_totals(chunk_audit_by_file(spark, sf_dir))


@query
def first_errors(spark, sf_dir):
    return audit.first_errors(_audited(spark, sf_dir))


@query
def file_report(spark, sf_dir):
    return report_of_files(fx.chunk_lines(spark, sf_dir), "chunk")


@query
def file_errors(spark, sf_dir):
    return errors_of_lines(fx.chunk_lines(spark, sf_dir), "chunk")


@query
def sample_chunk(spark, sf_dir):
    return audit.sample_chunk(fx.chunks(spark, sf_dir)).select(*CHUNK_SHAPE)


# --- streaming -------------------------------------------------------------------


@query
def streamed_progress(spark, sf_dir):
    """Progress of chunks whose events land first, and whose patience then runs out on the event clock."""
    folder = fx.shared_folder(spark, "progress")
    events = fx.progress_events(spark, sf_dir)
    tick = "SELECT 'tick' AS chunk_id, 'reply' AS kind, 1 AS attempt, CAST(array() AS array<string>) AS items, timestamp'2024-01-01 00:00:00' + INTERVAL '{} hours' AS at"
    for landed in (events, spark.sql(tick.format(9)), spark.sql(tick.format(18))):
        landed.write.mode("append").json(f"{folder}/landing")
        progress.follow_progress(spark, f"{folder}/landing", f"{folder}/closed", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(progress.PROGRESS_DDL).parquet(f"{folder}/closed").where("chunk_id <> 'tick'")


# --- packing ---------------------------------------------------------------------


def _ranked(spark: SparkSession, sf_dir: str, seed: int = fx.SEED) -> DataFrame:
    ids_only = durable(fx.chunks(spark, sf_dir).select("chunk_id"), "chunk-ids")
    return packing.shuffle_rank(ids_only, seed, key="chunk_id")


def _sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.assign_shards(packing.assign_splits(_ranked(spark, sf_dir), THREE), 50)


def _split_table(spark: SparkSession, sf_dir: str, ratios=THREE) -> DataFrame:
    return packing.split_table(packing.split_sizes(fx.chunks(spark, sf_dir), ratios), 50)


@query
def shuffle_rank(spark, sf_dir):
    return _ranked(spark, sf_dir)


@query
def permuted_rank(spark, sf_dir):
    """Ranks of stored rows by a bijection of their numbers."""
    return permutation.permuted_rank(fx.table(spark, sf_dir, "documents"), fx.SEED).select("doc_id", "rank", "total")


@query
def split_assign(spark, sf_dir):
    return packing.assign_splits(_ranked(spark, sf_dir), THREE).select("chunk_id", "split", "rank_in_split")


@query
def split_assign_unscaled(spark, sf_dir):
    return packing.assign_splits(_ranked(spark, sf_dir, 7), UNSCALED).select("chunk_id", "split", "rank_in_split")


@query
def split_counts(spark, sf_dir):
    return packing.split_sizes(fx.chunks(spark, sf_dir)).select("split", "num_items")


@query
def shard_assign(spark, sf_dir):
    return _sharded(spark, sf_dir).select("chunk_id", "split", "shard", "file", "rank_in_split")


@query
def shard_counts(spark, sf_dir):
    return packing.shard_counts(_sharded(spark, sf_dir))


@query
def manifest(spark, sf_dir):
    made = packing.manifest(_split_table(spark, sf_dir), fx.RUN_ID, fx.SEED, fx.STAMP)
    rows = made.select("run_id", "total_items", "shuffle_seed", F.explode("splits").alias("split", "v"))
    return rows.select("run_id", "total_items", "shuffle_seed", "split", "v.num_items", F.explode("v.shards").alias("s")).select(
        "run_id", "total_items", "shuffle_seed", "split", "num_items", "s.file", F.col("s.num_items").alias("shard_items")
    )


@query
def dataset_info(spark, sf_dir):
    made = packing.dataset_info(_split_table(spark, sf_dir), fx.RUN_ID, fx.SEED, fx.STAMP)
    rows = made.select("run_id", "total_items", "shuffle_seed", F.explode("splits").alias("split", "v"))
    return rows.select("run_id", "total_items", "shuffle_seed", "split", "v.*")


@query
def manifest_validation(spark, sf_dir):
    table = _split_table(spark, sf_dir, {"most": 0.6, "none": 0.0, "rest": 0.4})
    made = packing.manifest(table, fx.RUN_ID, fx.SEED, fx.STAMP)
    text = made.select("total_items", F.to_json(F.struct("*")).alias("value"))
    return validate_json(text, "manifest").select("total_items", "valid", _joined(by="; "))
