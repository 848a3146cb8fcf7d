import json
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from chunkwright import schemas
from chunkwright.operators import audit, prompts
from chunkwright.operators.chunking import ChunkOptions
from chunkwright.operators.completion import complete
from chunkwright.operators.packing import split_counts
from chunkwright.operators.validation import file_errors, file_report, validate_json
from chunkwright.plans.chunk_corpus import chunk_corpus
from chunkwright.plans.generate_verify import RunOptions, run_workspace
from chunkwright.plans.pack_dataset import pack_dataset
from chunkwright.session import durable, once, spread
from chunkwright.sources import jsonl, markdown, runs
from chunkwright.sources.shards import write_named_lines
from chunkwright.streaming.verify_stream import verify_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])
STAMP = "2024-01-01T00:00:00Z"
OPTIONS = ChunkOptions(64, 8, 10)


@pytest.fixture()
def corpus(tmp_path):
    root = tmp_path / "input"
    files = {
        "alpha/guide.md": b"# Guide\r\n\r\nfirst part\r\rlast\n",
        "alpha/deep/er/guide.md": ("word " * 300 + "\n\n## Next\n" + "more " * 100).encode(),
        "beta/empty.md": b"",
        "beta/bom.md": "﻿# Title\n日本語 text\n".encode(),
        "gamma/broken.md": b"ok \xff\xfe not utf-8",
        "delta/notes.txt": b"no markdown here",
        ".hidden/x.md": b"hidden",
        "top.md": b"in no project",
    }
    for name, content in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return root


def good_items(messages, attempt):
    marker = messages[1]["content"].split("part ")[1].split(",")[0]
    if marker == "0" and attempt == 1:
        return "  "
    if marker == "2":
        raise RuntimeError("model is away")
    text = "<|begin_of_thought|>t<|end_of_thought|><|begin_of_solution|>a<|end_of_solution|>"
    pair = [{"problem": f"q{marker}", "solution": text}, {"problem": "untagged", "solution": "plain"}]
    return "```json\n" + json.dumps(pair) + "\n```" if marker != "3" else "nonsense"


def judge(messages, attempt):
    return json.dumps({"passed": '"problem":"q1"' not in messages[1]["content"], "errors": []})


def test_documents_from_folders(spark, corpus):
    assert [r.project for r in markdown.discover_projects(spark, str(corpus)).collect()] == ["alpha", "beta", "gamma"]
    found = markdown.find_files(spark, str(corpus), "*.txt").select("relpath").collect()
    assert [r.relpath for r in found] == ["delta/notes.txt"]
    rows = {(r.project, r.file_path): r for r in markdown.read_markdown(spark, str(corpus), strict=False).collect()}
    assert set(rows) == {
        ("alpha", "guide.md"), ("alpha", "deep/er/guide.md"), ("beta", "empty.md"), ("beta", "bom.md"), ("gamma", "broken.md"),
    }
    import hashlib

    guide = rows["alpha", "guide.md"]
    assert guide.text == "# Guide\n\nfirst part\n\nlast\n" and guide.file_name == "guide.md"
    assert guide.file_sha1 == hashlib.sha1((corpus / "alpha/guide.md").read_bytes()).hexdigest()
    assert rows["beta", "bom.md"].text.startswith("﻿#")
    assert rows["gamma", "broken.md"].text is None
    with pytest.raises(Exception):
        markdown.read_markdown(spark, str(corpus)).collect()


def test_three_stages(spark, corpus, tmp_path):
    work, out = str(tmp_path / "work"), str(tmp_path / "out")
    totals = {tuple(r) for r in chunk_corpus(spark, str(corpus), work, OPTIONS, STAMP).collect()}
    alpha = next(t for t in totals if t[0] == "alpha")
    assert ("beta", 1, 2, 1) in totals and alpha[2] == 2
    assert spark.read.json(f"{work}/unreadable").select("file_path").first()[0] == "broken.md"

    chunks = jsonl.read_chunks(spark, f"{work}/chunks")
    assert [f.name for f in chunks.schema] == [f.name for f in spark.createDataFrame([], schemas.CHUNK_DDL).schema]
    lines = jsonl.numbered_lines(spark, f"{work}/chunks")
    by_file = audit.audit_by_file(audit.audit_lines(lines))
    ready = audit.audit_totals(by_file).first()
    assert ready.ready and ready.total_chunks == chunks.count()
    sample = audit.sample_chunk(chunks).first()
    assert (sample.project, sample.file_path, sample.chunk_index) == ("alpha", "deep/er/guide.md", 0)

    index = [r.chunk_index for r in chunks.collect()]
    fail = sum(i in (2, 3) for i in index)
    first = run_workspace(spark, work, good_items, judge, STAMP).first()
    assert first.total_chunks == len(index) and first.failed_chunks == fail
    assert first.total_generated == 2 * (len(index) - fail)
    assert first.total_verified == sum(i not in (1, 2, 3) for i in index)
    failed = {json.loads(r.value)["error_type"] for r in runs.current_lines(spark, work, "failed_chunks").collect()}
    assert failed == {"failed", "unreadable"}
    again = run_workspace(spark, work, good_items, None, STAMP, resume=True).first()
    assert again.total_chunks == sum(i in (1, 2, 3) for i in index)
    assert again.total_verified == sum(i == 1 for i in index)

    current = runs.current_lines(spark, work, "verified")
    verified = jsonl.checked_items(current)
    assert verified.where("NOT valid").count() == 0
    n = verified.count()
    table = pack_dataset(
        spark, current, out, "run_20240101_000000", STAMP, seed=42, ratios={"train": 0.5, "test": 0.5}, shard_size=2
    ).collect()
    assert sum(r.num_items for r in table) == n
    manifest = json.loads(Path(out, "manifest.json").read_text())
    assert manifest["total_items"] == n and manifest["shuffle_seed"] == 42 and list(manifest["splits"]) == ["train", "test"]
    info = json.loads(Path(out, "dataset_info.json").read_text())
    seen = []
    for split, entry in manifest["splits"].items():
        assert info["splits"][split] == {"num_items": entry["num_items"], "num_shards": len(entry["shards"])}
        for shard in entry["shards"]:
            records = [json.loads(x) for x in Path(out, "shards", shard["file"]).read_text().splitlines()]
            assert len(records) == shard["num_items"]
            seen += [r["id"] for r in records]
    assert len(seen) == len(set(seen)) == n
    assert not [p for p in Path(out).rglob(".*")if p.is_file() and not p.name.endswith(".crc")]


def simple_items(messages, attempt):
    text = "<|begin_of_thought|>t<|end_of_thought|><|begin_of_solution|>a<|end_of_solution|>"
    return json.dumps([{"problem": messages[0]["content"], "solution": text}])


def reject(messages, attempt):
    return '{"passed": false, "errors": ["wrong"]}'


def accept(messages, attempt):
    return '{"passed": true, "errors": []}' if messages[1]["content"].startswith("judge ") else reject(messages, attempt)


def test_runs_replace_each_other(spark, corpus, tmp_path):
    work = str(tmp_path / "work")
    chunk_corpus(spark, str(corpus), work, OPTIONS, STAMP)
    n = jsonl.read_chunks(spark, f"{work}/chunks").count()

    def ids(table):
        rows = [json.loads(r.value) for r in runs.current_lines(spark, work, table).collect()]
        return sorted(r.get("item", r)["id"] for r in rows)

    # A resumed run of a fresh workspace runs everything.
    assert run_workspace(spark, work, simple_items, reject, STAMP, resume=True).first().total_rejected == n
    made = ids("generations")
    assert ids("rejected") == made and len(set(made)) == n and ids("verified") == []
    # A run that ended before its commit row leaves the earlier one in place.
    stray = Path(work, "verified", "run=2")
    stray.mkdir()
    (stray / "part-0.json").write_text('{"id": "stray"}\n')
    assert ids("verified") == [] and ids("rejected") == made
    options = RunOptions(
        generation_system="own prompt", verification_template="judge {{ candidate_json }}", item_system="item prompt",
        defaults={"subject": "history"}, checks=["has_thought_begin_token"], concurrency=3, parallelism=2,
    )
    run_workspace(spark, work, simple_items, accept, STAMP, resume=True, options=options)
    assert ids("verified") == made and ids("generations") == made and ids("rejected") == []
    item = json.loads(runs.current_lines(spark, work, "verified").first().value)
    assert (item["problem"], item["system_prompt"], item["metadata"]["subject"]) == ("own prompt", "item prompt", "history")
    assert run_workspace(spark, work, simple_items, accept, STAMP, resume=True).first().total_chunks == 0
    # A fresh run starts over.
    run_workspace(spark, work, simple_items, reject, STAMP, options=RunOptions(save_rejected=False))
    assert ids("verified") == ids("rejected") == [] and ids("generations") == made


def test_packing_nothing(spark, tmp_path):
    source = tmp_path / "verified"
    source.mkdir()
    (source / "a.jsonl").write_text('{"id": "bad"}\n')
    table = pack_dataset(spark, str(source), str(tmp_path / "out"), "run_20240101_000000", STAMP, seed=1)
    assert [r.num_items for r in table.orderBy("position").collect()] == [0, 0]
    assert not (tmp_path / "out").exists()


def test_a_second_pack_replaces_the_first(spark, tmp_path):
    item = {
        "system_prompt": "s", "problem": "q", "solution": "a", "created_at": STAMP,
        "metadata": {
            "source": "s", "difficulty": "d", "subject": "s", "tags": ["t"], "project": "p", "file_path": "f", "file_name": "f",
            "chunk_index": 0, "chunk_id": "sha256:" + "0" * 64,
        },
        "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}],
    }
    lines = [json.dumps({"id": f"{i:08x}-0000-4000-8000-000000000000", **item}) for i in range(30)]
    df = spark.createDataFrame([("f", line) for line in lines], "file string, value string")
    out = tmp_path / "out"

    def pack(size):
        pack_dataset(spark, df, str(out), "run_20240101_000000", STAMP, seed=1, shard_size=size, ratios={"train": 1.0})
        return {p.name: len(p.read_text().splitlines()) for p in (out / "shards").iterdir()}

    assert pack(5) == {f"train-{i:05d}.jsonl": 5 for i in range(6)}
    assert pack(1000) == {"train-00000.jsonl": 30}
    # A job that fails leaves what was there.
    broken = df.select(F.lit("shards/train-00000.jsonl").alias("file"), F.raise_error("broken").cast("string").alias("value"))
    with pytest.raises(Exception):
        write_named_lines(broken, str(out), replace=["shards"])
    assert len((out / "shards" / "train-00000.jsonl").read_text().splitlines()) == 30
    assert not [p for p in out.iterdir() if p.name.startswith(".staged")]


def test_lines_and_files(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [f'{{"n": {i}, "pad": "{"x" * (i % 50)}"}}' if i % 7 else "" for i in range(5000)]
    (source / "big.jsonl").write_text("\n".join(rows) + "\n")
    (source / "small.jsonl").write_text('\n  \n{"n": 1}\n{broken\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        numbered = jsonl.numbered_lines(spark, str(source)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    big = {r.line: r.value for r in numbered if r.file.endswith("big.jsonl")}
    assert big == {i + 1: row for i, row in enumerate(rows) if row}
    counts = {r.file.rsplit("/", 1)[1]: r.lines for r in jsonl.count_lines(spark, str(source)).collect()}
    assert counts == {"big.jsonl": len(big), "small.jsonl": 2}
    assert jsonl.read_jsonl(spark, str(source / "small.jsonl"), "n INT", strict=False).where("_corrupt_record IS NOT NULL").count() == 1
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(source / "small.jsonl"), "n INT").collect()
    lines = jsonl.numbered_lines(spark, str(source / "small.jsonl"))
    assert [(r.valid, r.invalid) for r in file_report(lines, "manifest").collect()] == [(0, 2)]
    errors = [r.error for r in file_errors(lines, "manifest").orderBy("line").collect()]
    assert errors[0].startswith("Line 3: ") and errors[1] == "Line 4: Invalid JSON"


def test_json_round_trip_keeps_nulls_and_text(spark, tmp_path):
    df = spark.createDataFrame([("é日本 ", None)], "a string, b string").coalesce(1)
    jsonl.write_jsonl(df, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    assert json.loads(part.read_text()) == {"a": "é日本 ", "b": None} and "é" in part.read_text()
    assert jsonl.read_jsonl(spark, str(tmp_path / "out"), "a STRING, b STRING").collect() == df.collect()


def test_named_lines_are_whole_files_in_order(spark, tmp_path):
    df = spark.range(1000).select(
        F.format_string("d%d/f-%d.jsonl", F.col("id") % 2, F.col("id") % 5).alias("file"),
        (-F.col("id")).alias("n"),
        F.col("id").cast("string").alias("value"),
    )
    out = tmp_path / "out"
    write_named_lines(df, str(out), order="n")
    for path in out.rglob("*.jsonl"):
        values = [int(x) for x in path.read_text().split()]
        assert values == sorted(values, reverse=True) and len(values) == 100
    assert len(list(out.rglob("*.jsonl"))) == 10
    with pytest.raises(Exception):
        write_named_lines(df, str(out), overwrite=False)


def test_completion_attempts(spark):
    seen = spark.createDataFrame([(str(i), i) for i in range(40)], "request_id string, n int")
    requests = seen.select("request_id", prompts.messages("s", F.col("n").cast("string")).alias("messages"))

    def model(messages, attempt):
        n = int(messages[1]["content"])
        if n % 10 == 9:
            raise KeyError("k")
        return None if attempt <= n % 5 else f"r{n}"

    rows = {int(r.request_id): r for r in complete(requests, model).collect()}
    for n, r in rows.items():
        if n % 10 == 9:
            assert (r.status, r.attempt, r.error) == ("failed", 1, "KeyError: 'k'")
        elif n % 5 >= 3:
            assert (r.status, r.attempt, r.content) == ("empty", 3, None)
        else:
            assert (r.status, r.attempt, r.content) == ("ok", n % 5 + 1, f"r{n}")
    assert len(rows) == 40


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    landing, out, check = (str(tmp_path / n) for n in ("landing", "out", "check"))
    text = "<|begin_of_thought|>t<|end_of_thought|><|begin_of_solution|>a<|end_of_solution|>"

    def land(name, count, start):
        Path(landing).mkdir(exist_ok=True)
        rows = [
            {
                "chunk_id": f"sha256:{start + i:064x}", "project": "p", "file_path": "f", "file_name": "f",
                "chunk_index": i, "content": json.dumps([{"problem": "q", "solution": text if i % 2 else "bad"}]) if i % 5 else "x",
            }
            for i in range(count)
        ]
        Path(landing, name).write_text("\n".join(json.dumps(r) for r in rows))

    def counts():
        def rows(name):
            files = [p for p in Path(out, name).rglob("part-*.json")]
            return sum(len(p.read_text().splitlines()) for p in files)

        return rows("verified"), rows("rejected"), rows("failed")

    land("a.jsonl", 10, 0)
    verify_stream(spark, landing, out, check, STAMP).awaitTermination()
    assert counts() == (4, 4, 2)
    land("b.jsonl", 10, 100)
    verify_stream(spark, landing, out, check, STAMP).awaitTermination()
    assert counts() == (8, 8, 4)


def test_verification_prompt_holds_item_and_chunk(spark):
    chunk = spark.createDataFrame([("c1", "p", "f.md", 0, "chunk text")], "chunk_id string, project string, file_name string, chunk_index int, text string")
    item = {
        "id": "i1", "system_prompt": "s", "metadata": {"chunk_id": "c1"}, "messages": [], "problem": "q", "solution": "a", "created_at": STAMP,
    }
    items = spark.createDataFrame([(json.dumps(item),)], "v string").select(F.from_json("v", schemas.ITEM_DDL).alias("r")).select("r.*")
    row = prompts.verification_requests(items, chunk, "sys", "{{ candidate_json }}|{{ chunk_meta.file_name }}|{{ chunk_text }}").first()
    body, name, text = row.messages[1].content.split("|")
    assert (row.request_id, name, text) == ("i1", "f.md", "chunk text") and json.loads(body)["problem"] == "q"


def test_helpers(spark, tmp_path):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert once(df, {"x": F.col("x") + 1, "y": F.lit(1)}).orderBy("id").first().asDict() == {"id": 0, "x": 1, "y": 1}
    assert durable(df, "t").count() == 10
    df.coalesce(1).write.parquet(str(tmp_path / "p"))
    small = spark.read.parquet(str(tmp_path / "p"))
    assert spread(small, "id").rdd.getNumPartitions() >= 8
    assert spread(spark.range(0, 100, 1, 32)).rdd.getNumPartitions() == 32
    assert validate_json(spark.createDataFrame([("{}",)], "value string"), "chunk").first().valid is False
    assert split_counts(spark.createDataFrame([], "split string")).count() == 2
