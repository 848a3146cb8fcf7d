"""Secret scans through an incremental ledger of content-addressed blobs.

Every text, of whatever historical version, is a blob under the SHA-256 of its UTF-8 bytes.  The ledger
holds, per blob and rule version, the secrets found.  It grows by commits: only pairs of a blob and a rule
version that no other commit holds are scanned, once each, however many documents (paths) carry the
blob.  Findings are joined back to all documents.

A commit counts once it is whole, and one that is made again replaces itself, so nothing is found twice;
commits that were made at the same time may hold a pair both, which is read once.

Null and empty texts are the empty blob, without findings.  Repeated rows and null ``doc_id`` keep
their rows.  Other columns are ignored, and an empty table makes an empty commit.  Whole texts are scanned.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.llm.shared import keyed_texts

KINDS = ("assign", "access", "hex")
# The letters of the first pattern match in either case, of ASCII only.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
# Runs of these alphabets are maximal, so asking for the length at once finds the same spans.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RULES = ((ASSIGN.pattern, 6), (ACCESS.pattern, 20), (HEX.pattern, 24))
def _version(rules: Sequence[tuple[str, int]]) -> str:
    return hashlib.sha256(repr(tuple(rules)).encode()).hexdigest()[:16]


RULE_VERSION = _version(RULES)
# The rules before hexadecimal keys were added.
FIRST_RULE_VERSION = _version(RULES[:2])
KINDS_OF = {RULE_VERSION: (0, 1, 2), FIRST_RULE_VERSION: (0, 1)}
SPANS = "array<struct<kind:int,start:int,end:int>>"
LEDGER = f"blob string, rule_version string, spans {SPANS}"


def find_secrets(text: str, version: str = RULE_VERSION) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in code points, by start and then kind."""
    kinds = KINDS_OF[version]
    spans = []
    if ":" in text or "=" in text:
        spans += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    if 2 in kinds:
        spans += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], s[0]))


def blob_key(text: str = "text"):
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def scan_unseen(documents: DataFrame, ledger: DataFrame | None = None, versions: Sequence[str] = (RULE_VERSION,)) -> DataFrame:
    """Ledger rows of the pairs of blobs and rule versions that ``ledger`` lacks.

    Copies combine before the shuffle, so a text that a third of all rows carry costs one row
    per task, and the hash decides where a blob is scanned.
    """
    wanted = F.array(*[F.lit(v) for v in versions])
    blobs = keyed_texts(documents).select(blob_key().alias("blob"), "text").dropDuplicates(["blob"])
    if ledger is None:
        blobs = blobs.withColumn("missing", wanted)
    else:
        known = ledger.groupBy("blob").agg(F.collect_set("rule_version").alias("known"))
        missing = F.array_except(wanted, F.coalesce("known", F.array().cast("array<string>")))
        blobs = blobs.join(known, "blob", "left").select("blob", "text", missing.alias("missing")).where(F.size("missing") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            pairs = [(n, t, v) for n, (t, vs) in enumerate(zip(batch.column("text").to_pylist(), batch.column("missing").to_pylist())) for v in vs]
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t, v)] for _, t, v in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob").take(pa.array([n for n, *_ in pairs], pa.int64())), pa.array([v for *_, v in pairs], pa.string()), pa.array(found, kind)],
                ["blob", "rule_version", "spans"],
            )

    return blobs.mapInArrow(run, LEDGER)


def read_ledger(spark: SparkSession, path: str, but: str | None = None) -> DataFrame:
    """All rows of the whole commits below ``path``, one per blob and rule version; ``but`` names a commit to leave out."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []
    whole = [n for n in names if n.startswith("commit=") and n != f"commit={but}" and store.exists(folder.suffix(f"/{n}/_SUCCESS"))]
    if not whole:
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(*(f"{path}/{n}" for n in sorted(whole)))
    return rows.dropDuplicates(["blob", "rule_version"])


def update_ledger(documents: DataFrame, path: str, commit: str | None = None, versions: Sequence[str] = (RULE_VERSION,)) -> DataFrame:
    """Scan what the ledger at ``path`` lacks, commit it under a name, and return the whole ledger."""
    spark, commit = documents.sparkSession, commit or uuid.uuid4().hex
    scan_unseen(documents, read_ledger(spark, path, but=commit), versions).write.mode("overwrite").parquet(f"{path}/commit={commit}")
    return read_ledger(spark, path)


def scan_history(documents: DataFrame, path: str, commits: int = 3) -> DataFrame:
    """The ledger of documents that came in several commits, the first of them under two rule versions.

    A document's commit follows from its key; whole copies of what an earlier commit brought are not scanned again.
    """
    number = F.pmod(F.xxhash64("doc_id"), F.lit(commits))
    for n in range(commits):
        versions = (FIRST_RULE_VERSION, RULE_VERSION) if n == 0 else (RULE_VERSION,)
        update_ledger(documents.where(number == n), path, f"{n:04d}", versions)
    return read_ledger(documents.sparkSession, path)


def findings(documents: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per document: its blob and the spans found in it (empty array: none)."""
    known = ledger.where((F.col("rule_version") == RULE_VERSION) & (F.size("spans") > 0)).select("blob", "spans")
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), blob_key().alias("blob"))
    return rows.join(known, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans")
    )


def secret_digests(documents: DataFrame, ledger: DataFrame) -> DataFrame:
    found = findings(documents, ledger)
    names = F.array(*[F.lit(k) for k in KINDS])
    texts = F.transform("spans", lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    joined = F.array_join(texts, ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(joined.cast("binary"), 256).alias("base_sha256"),
        joined.alias("spans"),
    )
