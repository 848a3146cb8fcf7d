"""The registered queries of this package and their SQL, each over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.llm import alignment, bpe, decontaminate, hilbert, line_dedup, minhash, quality, repeats, runs, secrets, token_files, topk, toxicity
from chunkwright.session import checkpoint_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    """The public byte-level vocabulary the token queries are defined on."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    """The public piece model that is aligned with the byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_ball_tree_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


ORACLES["op1_ball_tree_topk"] = topk.ORACLE


@query
def op2_bottom_k_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


ORACLES["op2_bottom_k_dedup"] = minhash.ORACLE


@query
def op3_toxic_passages(spark, sf_dir):
    return toxicity.toxicity_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_hilbert_shards(spark, sf_dir):
    return hilbert.shard_digests(table(spark, sf_dir, "documents"))


@query
def op5_quality_votes(spark, sf_dir):
    return quality.quality_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_cgk_decontamination(spark, sf_dir):
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_line_dedup(spark, sf_dir):
    return line_dedup.line_decisions(table(spark, sf_dir, "documents"))


ORACLES["op7_line_dedup"] = line_dedup.ORACLE


@query
def op8_token_files(spark, sf_dir):
    return token_files.token_digests(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op9_secret_scan(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    ledger = secrets.scan_history(documents, f"{checkpoint_root(spark)}/secret-ledger-{uuid.uuid4().hex}")
    return secrets.secret_digests(documents, ledger)


@query
def op10_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op11_grammar_runs(spark, sf_dir):
    return runs.run_digests(table(spark, sf_dir, "documents"))


@query
def op12_winnowed_repeats(spark, sf_dir):
    return repeats.passage_digests(table(spark, sf_dir, "documents"))


ORACLES["op12_winnowed_repeats"] = repeats.ORACLE


@query
def op13_token_alignment(spark, sf_dir):
    return alignment.alignment_digests(table(spark, sf_dir, "documents"), vocabulary_path(), piece_model_path())
