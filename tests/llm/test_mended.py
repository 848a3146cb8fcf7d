"""Cases that earlier versions of the operators failed on."""

import random
import uuid

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from chunkwright.llm import bpe, decontaminate, hilbert, minhash, secrets
from chunkwright.llm.labelled import labelled_sample
from chunkwright.session import checkpoint_root


def test_near_duplicates_of_long_texts(spark):
    """Each text holds four of five common blocks, so any two share three of five and none is linked."""
    blocks = [" ".join(f"b{n}w{i}" for i in range(10_000)) for n in range(5)]
    rows = [(n, " ".join(b for k, b in enumerate(blocks) if k != n)) for n in range(5)]
    rows += [(10, rows[2][1] + " and little more"), (11, " ".join(blocks))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    # The whole of all blocks is linked to every text of four.
    assert {r.doc_id: r.component_id for r in found} == {n: 0 for n, _ in rows}
    found = minhash.near_duplicates(spark.createDataFrame(rows[:6], "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 10: 2}


def test_a_large_family_of_near_copies(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for n in range(3000):
        copy = list(words)
        copy[rng.randrange(60)] = f"x{n}"
        rows.append((n, " ".join(copy)))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(56)} for _, t in rows]
    parent = list(range(3000))

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a in range(3000):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {r.doc_id: r.component_id for r in found.collect()} == {n: root(n) for n in range(3000)}


def test_the_cap_on_labelled_rows_holds(spark):
    documents = spark.createDataFrame([(1, f"text {i}") for i in range(3000)] + [(n, "t") for n in range(2, 50)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(60)] + [(1, 0)], "doc_id bigint, toxic int")
    rows = labelled_sample(documents, labels, "toxic", F.lit(True), 10).collect()
    assert len(rows) <= 10 and len({r.doc_id for r in rows}) == len(rows)
    every = labelled_sample(documents, labels, "toxic", F.lit(True), 100).collect()
    assert len(every) == 49 and {r.label for r in every if r.doc_id == 1} == {1}


def test_the_ledger_scans_a_pair_once(spark):
    path = f"{checkpoint_root(spark)}/ledger-{uuid.uuid4().hex}"
    hexed = "0af" * 8
    first = spark.createDataFrame([(1, "token=abcdefg"), (2, hexed), (3, hexed), (4, None)], "doc_id bigint, text string")
    second = spark.createDataFrame([(5, hexed), (6, "new " + hexed), (7, "")], "doc_id bigint, text string")
    both = (secrets.FIRST_RULE_VERSION, secrets.RULE_VERSION)

    def scanned(commit):
        return sorted(map(tuple, spark.read.schema(secrets.LEDGER).parquet(f"{path}/commit={commit}").groupBy("rule_version").count().collect()))

    secrets.update_ledger(first, path, "a", (secrets.FIRST_RULE_VERSION,))
    assert scanned("a") == [(secrets.FIRST_RULE_VERSION, 3)]
    secrets.update_ledger(first, path, "b", both)
    assert scanned("b") == [(secrets.RULE_VERSION, 3)]
    ledger = secrets.update_ledger(second, path, "c")
    assert scanned("c") == [(secrets.RULE_VERSION, 1)]
    want = sorted(map(tuple, ledger.select("blob", "rule_version").collect()))
    # The same commit again, and one made at the same time as another, change nothing.
    again = secrets.update_ledger(second, path, "c")
    secrets.scan_unseen(second).write.parquet(f"{path}/commit=d")
    again = secrets.read_ledger(spark, path)
    assert sorted(map(tuple, again.select("blob", "rule_version").collect())) == want and len(want) == 7
    # A commit that is not whole does not count.
    secrets.scan_unseen(spark.createDataFrame([(9, "x")], "doc_id bigint, text string")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{path}/commit=e")
    assert secrets.read_ledger(spark, path).count() == 7
    spans = {r.doc_id: r.n_hex for r in secrets.secret_digests(first.unionByName(second), again).collect()}
    assert spans == {1: 0, 2: 1, 3: 1, 4: 0, 5: 1, 6: 1, 7: 0}
    old = again.where(F.col("rule_version") == secrets.FIRST_RULE_VERSION)
    assert old.agg(F.sum(F.size("spans"))).first()[0] == 1


def test_history_of_all_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ledger = secrets.scan_history(documents, f"{checkpoint_root(spark)}/ledger-{uuid.uuid4().hex}")
    whole = secrets.scan_unseen(documents)
    current = ledger.where(F.col("rule_version") == secrets.RULE_VERSION)
    assert sorted(map(str, current.collect())) == sorted(map(str, whole.collect()))


def _edited(rng, words, edits):
    copy = list(words)
    for kind in rng.integers(0, 3, edits).tolist():
        at = int(rng.integers(len(copy)))
        copy[at : at + (kind != 1)] = ["new"] * (kind != 2)
    return copy


@pytest.mark.parametrize("length", [6, 7, 9, 13, 25, 33, 120])
def test_items_of_every_length_are_found_through_the_embedding(length):
    rng = np.random.default_rng(length)
    items = [(i, [f"t{w}" for w in rng.integers(0, 5000, length)]) for i in range(40)]
    benchmark = decontaminate.Benchmark([(i, " ".join(words)) for i, words in items])
    assert {i for i, *_ in benchmark.segments} == set(range(40)) and not benchmark.short
    assert max(len(s) for *_, s in benchmark.segments) <= decontaminate.SEGMENT
    finder = decontaminate.Finder(benchmark)
    for share in (0.1, 0.15, 0.2):
        edits = min(decontaminate.budget(length), int(share * length)) if share < 0.2 else decontaminate.budget(length)
        texts = [" ".join(["host"] * 20 + _edited(rng, words, edits) + ["host"] * 20) for _, words in items]
        found = {row: n for row, item, _, _, n in finder(texts) if row == item}
        assert len(found) >= 38 and max(found.values()) <= edits


def test_matches_are_those_of_a_plain_edit_table(spark):
    """Every document against every item, by a table of edits over the whole text."""
    sf = "/root/testdata/sf0.001"
    documents, benchmark = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    words = {r.doc_id: decontaminate.words_of(r.text or "") for r in documents.collect()}
    items = {r.item_id: decontaminate.words_of(r.text or "") for r in benchmark.collect()}
    numbers: dict[str, int] = {}
    coded = lambda ws: np.array([numbers.setdefault(w, len(numbers)) for w in ws], np.int64)
    texts, wanted = {k: coded(w) for k, w in words.items()}, {}
    for item, ws in items.items():
        ids = coded(ws)
        for doc, text in texts.items():
            if len(text) and len(ids):
                least = int(decontaminate.least_edits(ids, text).min())
                if least <= decontaminate.budget(len(ids)):
                    wanted[doc, item] = least
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.matches(documents, benchmark).collect()}
    assert got == wanted and len(wanted) >= 3


def test_written_shards_keep_every_row_and_skip_files(spark, tmp_path):
    rows = [(1, "a", "en", "s"), (1, "a", "en", "s"), (None, "b", None, "s"), (None, None, "de", None), (2, "a b c", "en", "t")]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("shard", F.lit("old"))
    hilbert.write_shards(odd, str(tmp_path / "odd"), 3)
    back = spark.read.parquet(str(tmp_path / "odd")).select("doc_id", "text", "lang", "source").collect()
    assert sorted(map(str, back)) == sorted(str(r) for r in odd.drop("shard").collect())
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hilbert.write_shards(documents, str(tmp_path / "all"), 20)
    written = spark.read.parquet(str(tmp_path / "all"))
    assert written.count() == documents.count()
    # Readers that ask for one language or source find its rows in few of the files.
    for column in ("lang", "source"):
        held = written.groupBy(column).agg(F.countDistinct("shard").alias("files"))
        assert held.agg(F.avg("files")).first()[0] < 14
    both = written.groupBy("lang", "source").agg(F.countDistinct("shard").alias("files"), F.count(F.lit(1)).alias("n"))
    assert both.where("n > 5").agg(F.avg("files")).first()[0] < 8


class _Tasks:
    """Stands for a table and hands out the function of its tasks."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_texts_of_a_batch_are_encoded_in_bounded_parts(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(("one", "two", "three", "résumé", "x1"), k=4000)) for _ in range(500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    run = bpe.round_trip(_Tasks(), public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)
    parts, single = list(run(iter([batch]))), list(run(batch.slice(n, 1) for n in range(len(texts))))
    assert len(parts) > 1 and max(p.num_rows for p in parts) * 4000 * 4 < 2 * bpe.STEP_BYTES
    assert pa.Table.from_batches(parts).to_pylist() == pa.Table.from_batches(single).to_pylist()


def test_a_family_without_its_original_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Copies with one to six edits of a text that is not there; few pairs are looked at, and no link is lost."""
    rng = random.Random(9)
    original, copies = [f"w{i}" for i in range(150)], []
    for n in range(700):
        words = list(original)
        for at in rng.sample(range(150), 1 + n % 6):
            words[at] = f"x{rng.randrange(500)}"
        copies.append(words)
    rows = [(n, " ".join(words)) for n, words in enumerate(copies)]
    counts, known = [], minhash.cross_pairs

    def counted(sets):
        pairs = known(sets)
        counts.append(pairs.count())
        return pairs

    monkeypatch.setattr(minhash, "cross_pairs", counted)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)).collect()
    sets = [{tuple(words[i : i + 5]) for i in range(146)} for words in copies]
    least = list(range(700))

    def root(n):
        while least[n] != n:
            n = least[n]
        return n

    for a in range(700):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if 100 * same >= 75 * (len(sets[a]) + len(sets[b]) - same) and root(a) != root(b):
                least[max(root(a), root(b))] = min(root(a), root(b))
    assert {r.doc_id: r.component_id for r in found} == {n: root(n) for n in range(700)}
    assert sum(counts) < 10 * len(rows)
