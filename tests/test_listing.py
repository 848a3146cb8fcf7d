"""Listing and reading of file trees, and a sink whose files tasks move into place."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from chunkwright.sources import jsonl, listing, shards
from chunkwright.sources.markdown import discover_projects, find_files
from chunkwright.sources.shards import MARKER, STAGED, NamedLinesWriter, Written, finish_writes, write_named_lines


@pytest.fixture()
def tree(tmp_path):
    names = [f"p{i % 7}/a{i % 3}/b{i % 5}/f{i}.md" for i in range(400)]
    names += ["top.md", "p0/é ü%20+x.md", "p1/.hidden/_deep/x.md", "p2/empty.md", "p3/other.txt", ".dot/x.md", "alone/only/deep/down/y.md"]
    for name in names:
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if "empty" in name else name.encode())
    return tmp_path / "in", {n for n in names if n.endswith(".md")}


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_every_file_is_listed_once(spark, tree, prefix):
    root, names = tree
    rows = listing.list_files(spark, f"{prefix}{root}/", "*.md").collect()
    assert sorted(r.relpath for r in rows) == sorted(names)
    assert {r.relpath: r.length for r in rows} == {n: 0 if "empty" in n else len(n.encode()) for n in names}
    assert all(r.modified is not None for r in rows)


@pytest.mark.parametrize("tasks", [1, 2, 7, 64])
def test_shares_cover_the_tree_at_any_number(tree, tasks):
    root, names = tree
    reader = listing.FileListingReader(str(root), "*.md", tasks)
    shares = [[p for batch in reader.read(part) for p in batch.column("relpath").to_pylist()] for part in reader.partitions()]
    assert sorted(p for share in shares for p in share) == sorted(names)
    assert tasks == 1 or max(map(len, shares)) < len(names)


def test_contents_come_with_their_files(spark, tree, monkeypatch):
    root, names = tree
    monkeypatch.setattr(listing, "BATCH_BYTES", 100)
    monkeypatch.setattr(listing, "TASK_FILES", 50)
    found = find_files(spark, str(root)).collect()
    assert {(r.relpath, bytes(r.content)) for r in found} == {(n, b"" if "empty" in n else n.encode()) for n in names}
    assert len(found) == len(names) and {r.path for r in found} == {f"{root}/{n}" for n in names}


def test_projects_need_no_contents(spark, tree):
    root, _ = tree
    for path in root.rglob("*.md"):
        path.chmod(0)
    assert [r.project for r in discover_projects(spark, str(root)).collect()] == ["alone", *(f"p{i}" for i in range(7))]


def test_missing_and_empty_folders(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert listing.list_files(spark, str(tmp_path / "none")).count() == 0
    assert find_files(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception):
        listing.list_files(spark, str(tmp_path / "missing")).collect()


def _staged_write(out, names, count_all=True):
    """What a write leaves whose driver is lost after, or before, its commit."""
    writer = NamedLinesWriter(str(out), True, ["shards"])
    for attempt in ("won", "lost"):
        for name in names:
            path = out / writer.staging / attempt / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(f"{attempt}\n")
    if count_all:
        writer.commit([Written("won"), None])
    return writer


def test_an_interrupted_write_is_ended_by_the_next_one(spark, tmp_path, monkeypatch):
    out = tmp_path / "out"
    (out / "shards").mkdir(parents=True)
    (out / "shards" / "old.jsonl").write_text("old\n")
    (out / "kept.json").write_text("kept\n")
    names = [f"shards/s-{i}.jsonl" for i in range(20)] + ["info.json"]
    writer = _staged_write(out, names)
    # Some files were moved before the driver was lost.
    with monkeypatch.context() as lost, pytest.raises(ZeroDivisionError):
        lost.setattr(shards, "_move", lambda *_: 1 / 0)
        finish_writes(spark, str(out))
    (out / writer.staging / "won" / names[0]).rename(out / names[0])
    _staged_write(out, ["shards/never.jsonl"], count_all=False)
    finish_writes(spark, str(out))
    there = {str(p.relative_to(out)): p.read_text() for p in out.rglob("*") if p.is_file()}
    assert there["kept.json"] == "kept\n" and not (out / STAGED).exists()
    assert {n for n in there if "never" in n or "old" in n} == set()
    assert {n: t for n, t in there.items() if n != "kept.json"} == dict.fromkeys(names, "won\n")
    df = spark.range(30).select(F.format_string("shards/n-%d.jsonl", F.col("id") % 3).alias("file"), F.col("id").cast("string").alias("value"))
    _staged_write(out, ["late.json"])
    write_named_lines(df, str(out), replace=["shards"])
    assert (out / "late.json").read_text() == "won\n"
    assert sorted(p.name for p in (out / "shards").iterdir()) == ["n-0.jsonl", "n-1.jsonl", "n-2.jsonl"]


def test_the_marker_names_folders_only(tmp_path):
    writer = _staged_write(tmp_path, ["a.json"])
    assert json.loads((tmp_path / writer.staging / MARKER).read_text()) == {"folders": ["won"], "replace": ["shards"]}


LINES = {
    "a/plain.jsonl": b'{"n": 1}\n{"n": 2}\n', "a/no end.jsonl": b"x\ny", "b/c/crlf é%#.txt": b"one\r\ntwo\rthree\n\n \t\nfour\r\n", "b/bom": b"\xef\xbb\xbffirst\nsecond",
    "b/long": b"ab" * 5000 + b"\n" + b"c" * 17 + b"\r\n" + b"d" * 40, "b/bytes": b"\xff\xfe\xc3\x28\nok\n", "run=1/x": b"in a run\n", "_k=v/x": b"kept\n", "_metadata": b"kept\n",
    "empty": b"", "ends": b"\n\n\r", "_hidden/x": b"no\n", "d/_x": b"no\n", ".dot": b"no\n", "d/.dot/x": b"no\n", "y._COPYING_": b"no\n",
}


@pytest.mark.parametrize("size", [4, 7, 16, 17, 1 << 20])
def test_lines_read_by_tasks_are_those_of_sparks_reader(spark, tmp_path, monkeypatch, size):
    root = tmp_path / "li nes"
    for name, content in LINES.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    monkeypatch.setattr(listing, "RANGE_BYTES", size)
    made = jsonl.read_lines(spark, f"file:{root}/")
    assert "Scan text" not in made._jdf.queryExecution().executedPlan().toString()
    shape = ["file", F.hex(F.encode("value", "utf-8")).alias("value"), F.hex(F.col("value").cast("binary")).alias("bytes")]
    want = jsonl._lines_by_spark(spark, str(root)).where("trim(value) <> '' AND value <> ' \t'").select(*shape).collect()
    assert sorted(map(tuple, made.select(*shape).collect())) == sorted(map(tuple, want)) and len(want) == 17


def test_lines_of_files_that_tasks_do_not_read(spark, tmp_path):
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "a.jsonl.gz").write_bytes(gzip.compress(b"one\n\ntwo\n"))
    (tmp_path / "z" / "b.jsonl").write_bytes(b"three\n")
    for path in (tmp_path / "z", tmp_path / "*"):
        assert sorted(r.value for r in jsonl.read_lines(spark, str(path)).collect()) == ["one", "three", "two"]
    both = jsonl.read_lines(spark, str(tmp_path / "z" / "b.jsonl"), str(tmp_path))
    assert sorted(r.value for r in both.collect()) == ["one", "three", "three", "two"]
