"""Chunk progress as a stream with state against the batch result over all events."""

import json
import random
from datetime import datetime, timedelta

from chunkwright.streaming.progress import EVENTS_DDL, PROGRESS_DDL, follow_progress, progress_of

START = datetime(2024, 1, 1)


def _events(rng, chunks):
    """Attempts, verdicts before and after their reply, repeated and missing ones."""
    for n in range(chunks):
        key, begin = f"c{n}", START + timedelta(seconds=rng.randrange(600))
        attempts = rng.choice([1, 1, 2, 3])
        items = []
        for attempt in range(1, attempts + 1):
            # Only the last attempt brings items.
            items = [f"{key}-{i}" for i in range(rng.choice([0, 1, 2, 3]))] if attempt == attempts else []
            event = {"chunk_id": key, "kind": "reply", "attempt": attempt, "items": items, "at": begin + timedelta(seconds=attempt)}
            yield event
            if rng.random() < 0.3:
                yield event
        for item in items:
            if rng.random() < 0.85:
                event = {"chunk_id": key, "kind": "verdict", "item": item, "passed": rng.random() < 0.6, "at": begin + timedelta(seconds=rng.randrange(30))}
                yield event
                if rng.random() < 0.3:
                    yield event


def _land(folder, name, events):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps(e | {"at": e["at"].isoformat()}) for e in events]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_restarts_give_the_batch_result(spark, tmp_path):
    rng = random.Random(7)
    events = list(_events(rng, 60))
    rng.shuffle(events)
    landing, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    follow = lambda: follow_progress(spark, str(landing), out, check, 3600, 1).awaitTermination()
    read = lambda: sorted(tuple(r) for r in spark.read.schema(PROGRESS_DDL).parquet(out).collect())
    half = len(events) // 2
    _land(landing, "a.json", events[:half])
    follow()
    early = read()
    assert 0 < len(early) < 60 and {r[2] for r in early} == {"done"}
    # The same events again, the others, and then a clock that lets patience run out.
    _land(landing, "b.json", events[: half // 2] + events[half:])
    follow()
    tick = [{"chunk_id": "tick", "kind": "reply", "attempt": 1, "items": [], "at": START + timedelta(hours=h)} for h in (5, 9)]
    _land(landing, "c.json", tick[:1])
    _land(landing, "d.json", tick[1:])
    follow()
    want = progress_of(spark.read.schema(EVENTS_DDL).json([str(landing / f) for f in ("a.json", "b.json")]))
    got = [r for r in read() if r[0] != "tick"]
    assert got == sorted(tuple(r) for r in want.collect())
    assert {r[2] for r in got} == {"done", "open", "failed"} and len(got) == 60
    # Late events of closed chunks change nothing.
    late = [{"chunk_id": f"c{n}", "kind": "reply", "attempt": 9, "items": ["x"], "at": START + timedelta(hours=12)} for n in range(60)]
    _land(landing, "e.json", late)
    follow()
    assert [r for r in read() if r[0] != "tick"] == got
