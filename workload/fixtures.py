"""Stage inputs derived from the test tables.

Every SQL fragment here reads the same in Spark and in the oracle engine, so both sides
of a comparison start from equal inputs.  ``chr`` stands for characters whose literals
the two engines read differently.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.functions.ids import stable_uuid
from chunkwright.operators import checks, replies
from chunkwright.operators.chunking import ChunkOptions, chunk_documents
from chunkwright.operators.prompts import (
    GENERATION_SYSTEM,
    SOLUTION_BEGIN,
    SOLUTION_END,
    THOUGHT_BEGIN,
    THOUGHT_END,
)
from chunkwright.session import checkpoint_root, configure, durable, once, spread
from chunkwright.sources.shards import write_named_lines

STAMP = "2024-01-01T00:00:00Z"
RUN_ID = "run_20240101_000000"
SEED = 42
SMALL = ChunkOptions(max_tokens=64, overlap=8, tolerance_pct=10)
SHIPPED = ChunkOptions(max_tokens=4096, overlap=128, tolerance_pct=10)
PLAIN = ChunkOptions(max_tokens=64, overlap=8, semantic_breaks=False)

BACKSLASH = "chr(92)"
NEWLINE = "chr(10)"


def text_of(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


# Markdown with every kind of break; one document in eleven is a single long line.
MARKDOWN = f"""concat('# Doc ', {text_of('doc_id')}, {NEWLINE}, {NEWLINE}, CASE doc_id % 11
 WHEN 3 THEN replace(text, concat('.', {NEWLINE}), concat('.', {NEWLINE}, 'Title', {NEWLINE}, '===', {NEWLINE}))
 WHEN 5 THEN replace(text, concat('.', {NEWLINE}), concat('.', {NEWLINE}, 'Title', {NEWLINE}, ' --- ', {NEWLINE}))
 WHEN 7 THEN replace(text, concat('.', {NEWLINE}), concat('.', {NEWLINE}, '#tag', {NEWLINE}))
 WHEN 9 THEN replace(text, {NEWLINE}, ' ')
 ELSE replace(text, concat('.', {NEWLINE}), concat('.', {NEWLINE}, {NEWLINE}, '## S', {NEWLINE})) END)"""
DOCUMENT = {
    "project": "source",
    "file_path": f"concat('d', {text_of('doc_id % 7')}, '/', {text_of('doc_id')}, '.md')",
    "file_name": f"concat({text_of('doc_id')}, '.md')",
    "text": MARKDOWN,
}
DOC_ID = "CAST(replace(file_name, '.md', '') AS BIGINT)"


def json_text(expr: str) -> str:
    """A JSON string of a text that holds no other control character than the newline."""
    quoted = f"replace({expr}, {BACKSLASH}, concat({BACKSLASH}, {BACKSLASH}))"
    quoted = f"replace({quoted}, chr(34), concat({BACKSLASH}, chr(34)))"
    quoted = f"replace({quoted}, {NEWLINE}, concat({BACKSLASH}, 'n'))"
    return f"concat(chr(34), {quoted}, chr(34))"


def solution(case: str, body: str) -> str:
    """Seven tag cases: valid, four kinds of missing or misplaced tags, end first, valid."""
    tb, te, sb, se = (f"'{t}'" for t in (THOUGHT_BEGIN, THOUGHT_END, SOLUTION_BEGIN, SOLUTION_END))
    return f"""CASE {case}
 WHEN 0 THEN concat({tb}, {body}, {te}, {sb}, 'Answer', {se})
 WHEN 1 THEN concat({tb}, {body}, {sb}, 'Answer', {se})
 WHEN 2 THEN concat({tb}, {body}, {te}, {sb}, 'Answer')
 WHEN 3 THEN {body}
 WHEN 4 THEN concat({sb}, 'Answer', {se}, {tb}, {body}, {te})
 WHEN 5 THEN concat({te}, {body}, {tb}, {sb}, 'Answer', {se})
 ELSE concat({tb}, {body}, {te}, {sb}, {BACKSLASH}, 'boxed{{4}}', {se}) END"""


CASE_OF_CHUNK = "(doc_id + chunk_index) % 12"
PROBLEM_1 = f"concat('What does part ', {text_of('chunk_index')}, ' of ', file_name, ' say?')"
PROBLEM_2 = f"concat('Which file holds part ', {text_of('chunk_index')}, '?')"
SOLUTION_1 = solution("(doc_id + chunk_index) % 7", "text")
SOLUTION_2 = solution("(doc_id + chunk_index + 3) % 7", f"concat('Part ', {text_of('chunk_index')})")
ESCAPED_PROBLEM = f"concat({BACKSLASH}, 'q ', {PROBLEM_1})"

# Objects and bodies build on each other, so each level names the columns of the one before.
REPLY_PARTS = {
    "first_item": f"concat('{{\"problem\": ', {json_text(PROBLEM_1)}, ', \"solution\": ', {json_text(SOLUTION_1)}, '}}')",
    "second_item": f"concat('{{\"problem\": ', {json_text(PROBLEM_2)}, ', \"solution\": ', {json_text(SOLUTION_2)}, '}}')",
    # The bad escape stands where the first problem starts.
    "escaped_item": (
        f"concat('{{\"problem\": \"', {BACKSLASH}, 'q ', substr({json_text(PROBLEM_1)}, 2), "
        f"', \"solution\": ', {json_text(SOLUTION_1)}, '}}')"
    ),
    "number_item": f"concat('{{\"problem\": 7, \"solution\": ', {json_text(SOLUTION_1)}, '}}')",
}
# What stands inside the fence, if there is one, of every reply case.
REPLY_BODY = f"""CASE {CASE_OF_CHUNK}
 WHEN 3 THEN concat('[', first_item, ', ', second_item, ',', {NEWLINE}, ']')
 WHEN 4 THEN concat('[', escaped_item, ', ', second_item, ']')
 WHEN 5 THEN concat('[', escaped_item, ', ', second_item, ', ]')
 WHEN 6 THEN first_item
 WHEN 7 THEN concat('[', first_item, ', {{"problem": "alone"}}]')
 WHEN 8 THEN concat('[', first_item, ', {{"problem": ')
 WHEN 9 THEN ''
 WHEN 10 THEN concat('[', first_item, ', 5]')
 WHEN 11 THEN concat('[', number_item, ', ', second_item, ']')
 ELSE concat('[', first_item, ', ', second_item, ']') END"""
REPLY = f"""CASE {CASE_OF_CHUNK}
 WHEN 1 THEN concat('```json', {NEWLINE}, body, {NEWLINE}, '```')
 WHEN 2 THEN concat('Here it is:', {NEWLINE}, '```', {NEWLINE}, body, {NEWLINE}, '```', {NEWLINE}, 'Done')
 WHEN 5 THEN concat('```json', {NEWLINE}, body, {NEWLINE}, '```')
 WHEN 9 THEN concat(' ', {NEWLINE}, ' ')
 ELSE body END"""

# What the verifying model says of an item, by the label of its document.
VERDICT_REPLY = """CASE
 WHEN toxic = 1 THEN 'I cannot judge this'
 WHEN quality = 0 THEN '{"passed": false, "errors": ["low quality"], "reasoning": "label"}'
 WHEN doc_id % 5 = 0 THEN '[]'
 WHEN doc_id % 5 = 1 THEN '{"passed": true, "errors": "none"}'
 ELSE '{"passed": true, "errors": []}' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, project, file_path, file_name, text, file_sha1)``."""
    shaped = raw_documents(spark, sf_dir).select(
        "doc_id", *[F.expr(sql).alias(name) for name, sql in DOCUMENT.items()]
    )
    return shaped.withColumn("file_sha1", F.sha1("text"))


def chunks(spark: SparkSession, sf_dir: str, options: ChunkOptions = SMALL) -> DataFrame:
    return chunk_documents(documents(spark, sf_dir), options, STAMP)


def stored_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk table written once, for queries that read it several times.

    Cutting chunks is the costly step; reading back a few columns of them is not.
    """
    return durable(chunks(spark, sf_dir), "chunks")


def chunk_replies(made: DataFrame) -> DataFrame:
    """One made-up reply per chunk, twelve cases around two known items.

    The quoted texts that the items share are made once, and each reply of the items it needs.
    """
    keep = ["doc_id", "chunk_id", "project", "file_path", "file_name", "chunk_index"]
    keyed = made.withColumn("doc_id", F.expr(DOC_ID)).select(*keep, "text")
    texts = {"problem_1": PROBLEM_1, "problem_2": PROBLEM_2, "solution_1": SOLUTION_1, "solution_2": SOLUTION_2}

    def quoted(sql: str) -> Column:
        """``json_text``; only texts with a backslash or quote are searched for each of them."""
        rare = F.contains(F.expr(sql), F.expr(BACKSLASH)) | F.contains(F.expr(sql), F.lit('"'))
        lines = F.expr(f"concat(chr(34), replace({sql}, {NEWLINE}, concat({BACKSLASH}, 'n')), chr(34))")
        return F.when(rare, F.expr(json_text(sql))).otherwise(lines)

    parts = once(keyed, {f"{name}_json": quoted(sql) for name, sql in texts.items()}).drop("text")
    body = REPLY_BODY
    for part, sql in REPLY_PARTS.items():
        for name, text in texts.items():
            sql = sql.replace(json_text(text), f"{name}_json")
        body = body.replace(part, sql)
    return once(once(parts, {"body": F.expr(body)}), {"content": F.expr(REPLY)}).select(*keep, "content")


def parsed_replies(made: DataFrame) -> DataFrame:
    return replies.parse_replies(chunk_replies(made).drop("doc_id"))


def items(made: DataFrame) -> DataFrame:
    return replies.build_items(replies.reply_elements(parsed_replies(made)), STAMP)


def checked_items(made: DataFrame) -> DataFrame:
    return checks.local_checks(items(made))


def verdict_replies(spark: SparkSession, sf_dir: str, made: DataFrame) -> DataFrame:
    """Replies of the verifying model for both item positions of labelled documents."""
    asked = made.select(
        F.expr(DOC_ID).alias("doc_id"), "chunk_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("position")
    )
    return asked.join(table(spark, sf_dir, "labels"), "doc_id").select(
        stable_uuid(F.col("chunk_id"), F.col("position")).alias("request_id"),
        F.lit("ok").alias("status"),
        F.expr(VERDICT_REPLY).alias("content"),
        F.lit(None).cast("string").alias("error"),
    )


def reported_items(spark: SparkSession, sf_dir: str, made: DataFrame) -> DataFrame:
    verdicts = checks.read_verdicts(verdict_replies(spark, sf_dir, made))
    return checks.merge_verdicts(checked_items(made), verdicts, STAMP)


# Faults planted in conversation items, by conversation.
CONVERSATION_FAULTS = {1: "id", 2: "problem", 3: "role", 4: "tags", 5: "messages", 6: "solution"}


def conversation_items(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """Items of each user turn and the assistant turn right after it.

    The pair is an equi-join on conversation and turn, so a conversation with very many
    turns is spread like any other rows.
    """
    turns = table(spark, sf_dir, "conversations")
    user = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("problem"))
    reply = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    pairs = user.join(reply, ["conv_id", "turn"])
    fault = F.col("conv_id") % 8 if faults else F.lit(0)

    def planted(name: str, bad: Column, good: Column) -> Column:
        number = next(n for n, what in CONVERSATION_FAULTS.items() if what == name)
        return F.when(fault == number, bad).otherwise(good)

    text = F.concat(
        F.lit(THOUGHT_BEGIN), F.col("problem"), F.lit(THOUGHT_END), F.lit(SOLUTION_BEGIN), F.col("answer"),
        F.lit(SOLUTION_END),
    )
    role = planted("role", F.lit("tool"), F.lit("assistant"))
    both = F.array(
        F.struct(F.lit("user").alias("role"), F.col("problem").alias("content")),
        F.struct(role.alias("role"), text.alias("content")),
    )
    return pairs.select(
        "conv_id",
        "turn",
        planted("id", F.lit("no-uuid"), stable_uuid(F.col("conv_id"), F.col("turn"))).alias("id"),
        F.lit(GENERATION_SYSTEM).alias("system_prompt"),
        F.struct(
            F.lit("conversation").alias("source"),
            F.lit("medium").alias("difficulty"),
            F.lit("general").alias("subject"),
            planted("tags", F.array(F.lit("a"), F.lit("")), F.array(F.lit("chat"))).alias("tags"),
        ).alias("metadata"),
        planted("messages", F.slice(both, 1, 1), both).alias("messages"),
        planted("problem", F.lit(""), F.col("problem")).alias("problem"),
        planted("solution", F.lit(None).cast("string"), text).alias("solution"),
        F.lit(STAMP).alias("created_at"),
    )


# Faults planted in chunk lines, by document.
LINE_FAULT = "doc_id % 9"


def chunk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk JSON lines ``(file, line, value)`` with planted faults."""
    made = chunks(spark, sf_dir).withColumn("doc_id", F.expr(DOC_ID))
    fault = F.expr(LINE_FAULT)
    record = F.to_json(F.struct(*[c for c in made.columns if c != "doc_id"]))
    return made.select(
        F.concat("project", F.lit("/"), "file_path", F.lit(".chunks.jsonl")).alias("file"),
        (F.col("chunk_index") + 1).alias("line"),
        F.when((fault == 1) & (F.col("chunk_index") == 0), F.concat(record, F.lit(" x")))
        .when(fault == 2, F.regexp_replace(record, r'^\{"chunk_id":"sha256:', '{"chunk_id":"md5:'))
        .when(fault == 3, F.regexp_replace(record, r'^\{', '{"extra":1,'))
        .when(fault == 4, F.regexp_replace(record, r'"chunk_index":\d+', '"chunk_index":"one"'))
        .when(fault == 5, F.regexp_replace(record, '"source_format":"markdown"', '"source_format":"html"'))
        .otherwise(record)
        .alias("value"),
    )


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def markdown_folder(spark: SparkSession, sf_dir: str) -> str:
    """The documents as markdown files, each text with a newline at its end; one in thirteen is no markdown."""
    folder = shared_folder(spark, "markdown")
    name = F.when(F.col("doc_id") % 13 == 0, F.concat("file_path", F.lit(".txt"))).otherwise(F.col("file_path"))
    files = documents(spark, sf_dir).select(F.concat("project", F.lit("/"), name).alias("file"), F.col("text").alias("value"))
    write_named_lines(files, folder)
    return folder


def lines_folder(lines: DataFrame, name: str) -> str:
    """Rows ``(file, line, value)`` as the lines of files."""
    folder = shared_folder(lines.sparkSession, name)
    write_named_lines(lines, folder, order="line")
    return folder


def progress_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply of each document's attempts, and the verdicts on the items of its last one, some of which never come."""
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("chunk_id"), "doc_id")
    at = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id % 3000)")
    attempts = docs.select("*", F.explode(F.expr("sequence(1, int(1 + doc_id % 3))")).alias("attempt"))
    last = F.expr("attempt = 1 + doc_id % 3 AND doc_id % 4 > 0")
    items = F.expr("transform(sequence(0, int(doc_id % 4) - 1), i -> concat(chunk_id, '-', i))")
    replies = attempts.select(
        "chunk_id", F.lit("reply").alias("kind"), "attempt", F.when(last, items).otherwise(F.array().cast("array<string>")).alias("items"),
        F.lit(None).cast("string").alias("item"), F.lit(None).cast("boolean").alias("passed"), at.alias("at"),
    )
    verdicts = docs.where("doc_id % 4 > 0").select("*", F.explode(F.expr("sequence(0, int(doc_id % 4) - 1)")).alias("i")).where("(doc_id + i) % 7 > 0")
    return replies.unionByName(
        verdicts.select(
            "chunk_id", F.lit("verdict").alias("kind"), F.lit(None).cast("int").alias("attempt"), F.lit(None).cast("array<string>").alias("items"),
            F.expr("concat(chunk_id, '-', i)").alias("item"), F.expr("(doc_id + i) % 3 > 0").alias("passed"), at.alias("at"),
        )
    )
