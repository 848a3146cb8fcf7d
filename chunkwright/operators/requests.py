"""Size estimates and minute-by-minute plans of request tables, and resuming a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.functions.text import WORD_CHAR
from chunkwright.operators.ranking import running_totals
from chunkwright.session import durable

# Tokens per word of the estimate, and the default budget per minute.
TOKENS_PER_WORD = 1.3
REQUESTS_PER_MINUTE = 120
TOKENS_PER_MINUTE = 200_000


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.regexp_count(text, F.lit(f"{WORD_CHAR}++"))


def token_estimate(messages: Column, max_tokens: int = 4096) -> Column:
    """Estimated tokens of a request and its reply: words times 1.3, plus the reply limit."""
    prompt = F.aggregate(
        messages, F.lit(0.0), lambda acc, m: acc + word_count(m["content"]) * F.lit(TOKENS_PER_WORD)
    )
    return (prompt + F.lit(max_tokens)).cast("bigint")


def request_plan(
    requests: DataFrame,
    max_tokens: int = 4096,
    requests_per_minute: int = REQUESTS_PER_MINUTE,
    tokens_per_minute: int = TOKENS_PER_MINUTE,
    lane: str | None = None,
) -> DataFrame:
    """The minute each request may start in under a request and a token budget.

    Requests of a lane go in the order of a hash of their id.  One whose own estimate
    is above the token budget can never start: it is marked ``rejected``, gets no
    minute and uses no budget.
    """
    if requests_per_minute <= 0 or tokens_per_minute <= 0:
        raise ValueError("budgets must be positive")
    lanes = [lane] if lane else []
    # The texts are read once: the plan below passes twice over the small table of estimates.
    estimates = durable(
        requests.select("request_id", *lanes, token_estimate(F.col("messages"), max_tokens).alias("estimate")),
        "estimates",
    )
    sized = estimates.withColumns(
        {"_digest": F.sha2("request_id", 256), "rejected": F.col("estimate") > tokens_per_minute}
    )
    charged = running_totals(
        sized,
        "_digest",
        {
            "requests": F.when(F.col("rejected"), 0).otherwise(1),
            "tokens": F.when(F.col("rejected"), 0).otherwise(F.col("estimate")),
        },
        tie=["request_id"],
        lanes=lanes,
    )
    minute = F.greatest(
        F.floor((F.col("requests") - 1) / requests_per_minute), F.floor((F.col("tokens") - 1) / tokens_per_minute)
    )
    return charged.select(
        "request_id",
        *lanes,
        "estimate",
        "rejected",
        F.when(~F.col("rejected"), minute).cast("bigint").alias("minute"),
    )


def pending_chunks(chunks: DataFrame, verified: DataFrame) -> DataFrame:
    """Chunks without a verified item; chunks whose items were all rejected come again."""
    done = verified.select(F.col("metadata.chunk_id").alias("chunk_id")).distinct()
    return chunks.join(done, "chunk_id", "left_anti")
