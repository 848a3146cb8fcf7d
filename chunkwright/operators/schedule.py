"""When requests may start under two token buckets, as an exact scan over a whole table.

Both buckets, of requests and of tokens, hold a minute's budget, begin full and fill at an even rate.  A request
takes one request and its estimate at the earliest time, not before the one ahead of it, at which both are there.

Let ``t`` be the last start, and ``u`` and ``v`` the times at which the token and the request bucket would have been
empty, had they filled to their present level without a cap.  A request that needs ``w`` units of time to fill
its tokens, where one request needs ``q`` and a minute has ``K``, makes of them::

    t' = max(t, u + w, v + q)      u' = max(t' - K, u) + w      v' = max(t' - K, v) + q

These are linear over maximum and sum, so any number of requests in a row is one 3 x 3 matrix.  Rows are ordered by a
digest.  Rows with equal leading digits make one matrix, up to 256 of those make the next one, and so on; then
the states go down the same tree.  No group holds more than some hundreds of rows, whatever the size of a lane.

Time is counted in units of which one request and one token need whole numbers: nothing is rounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.operators.requests import REQUESTS_PER_MINUTE, TOKENS_PER_MINUTE, token_estimate
from chunkwright.session import durable

# Hex digits by which a group is split on the next level.
DIGITS = 2
_NONE = -(10**18)


def _vector(t: str, u: str, v: str) -> str:
    return f"named_struct('t', cast({t} AS bigint), 'u', cast({u} AS bigint), 'v', cast({v} AS bigint))"


def _bind(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _step(x: str, w: str, q: int, k: int) -> str:
    """The state after a request that needs ``w``."""
    return _bind(f"greatest({x}.t, {x}.u + {w}, {x}.v + {q})", "now", _vector("now", f"greatest(now - {k}, {x}.u) + {w}", f"greatest(now - {k}, {x}.v) + {q}"))


def _applied(m: str, x: str) -> str:
    """The state after the requests of a matrix, whose columns ``a, b, c`` stem from ``t, u, v``."""
    return _vector(*(f"greatest({m}.a.{f} + {x}.t, {m}.b.{f} + {x}.u, {m}.c.{f} + {x}.v)" for f in "tuv"))


def _folded(rows: str, begin: str, step) -> str:
    """The three columns of the product over sorted rows."""
    return f"aggregate({rows}, {begin}, (m, r) -> named_struct({', '.join(f"'{c}', {step(f'm.{c}')}" for c in 'abc')}))"


_IDENTITY = f"named_struct('a', {_vector('0', _NONE, _NONE)}, 'b', {_vector(_NONE, '0', _NONE)}, 'c', {_vector(_NONE, _NONE, '0')})"


def bucket_starts(df: DataFrame, digest: str, need: str, q: int, k: int, lanes: list[str]) -> DataFrame:
    """Add ``start``, in units, to rows that need ``need`` units of tokens, in the order of a unique hex digest.

    Other columns travel through the tree's lowest level only.
    """
    kept = [c for c in df.columns if c not in lanes]
    most = df.groupBy(*lanes).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    depth, held = 0, 256
    while held < most:
        depth, held = depth + 1, held * 256
    row = F.struct(F.col(digest).alias("_key"), F.col(need).alias("_need"), F.struct(*kept).alias("_row"))
    level = df.select(*lanes, F.substring(digest, 1, DIGITS * depth).alias("_prefix"), row.alias("_r"))
    # Sorting the lists makes the result independent of the order in which rows arrive.
    levels = [durable(level.groupBy(*lanes, "_prefix").agg(F.array_sort(F.collect_list("_r")).alias("_rows")), "schedule")]
    matrix = _folded("_rows", _IDENTITY, lambda x: _step(x, "r._need", q, k))
    for digits in range(DIGITS * (depth - 1), -1, -DIGITS):
        parts = levels[-1].select(*lanes, F.col("_prefix").alias("_key"), F.expr(matrix).alias("_m"))
        upper = parts.select(*lanes, F.substring("_key", 1, digits).alias("_prefix"), F.struct("_key", "_m").alias("_r"))
        levels.append(durable(upper.groupBy(*lanes, "_prefix").agg(F.array_sort(F.collect_list("_r")).alias("_rows")), "schedule"))
        matrix = f"aggregate(slice(_rows, 2, size(_rows)), _rows[0]._m, (m, r) -> named_struct({', '.join(f"'{c}', {_applied('r._m', f'm.{c}')}" for c in 'abc')}))"
    state = levels[-1].select(*lanes, "_prefix", F.expr(_vector("0", -k, -k)).alias("_state"))
    for groups in levels[:0:-1]:
        state = _descend(groups, state, lanes, _applied("r._m", "acc.s"), "acc.s").select(
            *lanes, F.col("_o.r._key").alias("_prefix"), F.col("_o.s").alias("_state")
        )
    started = _descend(levels[0], state, lanes, _step("acc.s", "r._need", q, k), "next.s")
    return started.select(*lanes, "_o.r._row.*", F.col("_o.s.t").alias("start"))


def _descend(groups: DataFrame, state: DataFrame, lanes: list[str], after: str, told: str) -> DataFrame:
    """Rows ``_o`` of each group's elements ``r`` with the state ``s`` before them (``acc.s``) or after them (``next.s``)."""
    both = groups.join(state, [*lanes, "_prefix"])
    # Lists grow by runs of at most 16, so that copies stay short.
    chunks = "transform(sequence(0, (size(_rows) - 1) div 16), i -> slice(_rows, 16 * i + 1, 16))"
    out = "cast(array() AS array<struct<r: {0}, s: struct<t: bigint, u: bigint, v: bigint>>>)".format(
        groups.schema["_rows"].dataType.elementType.simpleString()
    )
    element = f"named_struct('r', r, 's', {told})"
    inner = f"(acc, r) -> transform(array(named_struct('s', {after})), next -> named_struct('s', next.s, 'o', concat(acc.o, array({element}))))[0]"
    scan = f"""aggregate({chunks}, named_struct('s', _state, 'o', {out}), (all, part) ->
      transform(array(aggregate(part, named_struct('s', all.s, 'o', {out}), {inner})), done -> named_struct('s', done.s, 'o', concat(all.o, done.o)))[0],
      all -> all.o)"""
    return both.select(*lanes, F.explode_outer(F.expr(scan)).alias("_o")).where("_o IS NOT NULL")


def request_schedule(
    requests: DataFrame,
    max_tokens: int = 4096,
    requests_per_minute: int = REQUESTS_PER_MINUTE,
    tokens_per_minute: int = TOKENS_PER_MINUTE,
    lane: str | None = None,
) -> DataFrame:
    """``request_id``, lane, ``estimate``, ``rejected``, ``start_units``, ``start_seconds`` and ``minute`` of requests that wait from time 0 on.

    Requests of a lane go in the order of a hash of their id.  One whose own estimate is above the budget of
    a minute can never start: it is marked ``rejected``, has no start and uses no budget.  A minute has
    ``requests_per_minute * tokens_per_minute`` units.
    """
    if requests_per_minute <= 0 or tokens_per_minute <= 0:
        raise ValueError("budgets must be positive")
    lanes = [lane] if lane else []
    estimates = durable(
        requests.select("request_id", *lanes, token_estimate(F.col("messages"), max_tokens).alias("estimate")), "estimates"
    )
    minute = requests_per_minute * tokens_per_minute
    sized = estimates.where(F.col("estimate") <= tokens_per_minute).withColumns(
        {"_digest": F.concat(F.sha2(F.col("request_id").cast("string"), 256), F.col("request_id").cast("string")), "_need": F.col("estimate") * requests_per_minute}
    )
    started = bucket_starts(sized, "_digest", "_need", tokens_per_minute, minute, lanes).select("request_id", *lanes, "estimate", "start")
    rejected = estimates.where(F.col("estimate") > tokens_per_minute).select("request_id", *lanes, "estimate", F.lit(None).cast("bigint").alias("start"))
    return started.unionByName(rejected).select(
        "request_id", *lanes, "estimate", F.col("start").isNull().alias("rejected"), F.col("start").alias("start_units"),
        (F.col("start") * 60 / F.lit(minute)).alias("start_seconds"), F.expr(f"start div {minute}").alias("minute"),
    )
