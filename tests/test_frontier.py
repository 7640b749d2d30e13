"""Rows held back until the frontier passes: released once, in the right batch, also after retries."""

import json
import random
from decimal import Decimal

import pytest
from tests.helpers import value
from pyspark.sql import functions as F

from tideline.functions.clock import event_clock, hybrid_time
from tideline.operators.apply import progress
from tideline.sources.logs import RAW_SCHEMA
from tideline.streaming import run
from tideline.streaming.frontier import FrontierRelease


def mark(at, wrapped=False):
    return json.dumps({"payload": {"resolved": at}} if wrapped else {"resolved": at})


def log(spark, events, first=0):
    """``events`` are (topic, partition, time of a row or a mark as text)."""
    rows = [(t, p, first + i, None, None, e if isinstance(e, str) else value("c", {"id": first + i}, ts_ms=e)) for i, (t, p, e) in enumerate(events)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def data(raw):
    found = raw.filter(F.get_json_object("value", "$.op") == "c")
    return found.select("topic", "offset", F.get_json_object("value", "$.ts_ms").cast("bigint").alias("ts_ms"))


def batches(spark, tmp_path, batches_, retry=(), **how):
    release = FrontierRelease(str(tmp_path / "r"), width=10, **how)
    first, last = 0, len(batches_) - 1
    for k, events in enumerate(batches_):
        raw = log(spark, events, first)
        for _ in range(2 if k in retry else 1):
            release.write_batch(raw, data(raw), k)
        first += len(events)
    got = run.read_batches(spark, f"{release.path}/released").select("batch_id", "offset").collect()
    held = release.waiting(spark, data(log(spark, [])), last).select("offset").collect()
    return sorted(map(tuple, got)), sorted(r.offset for r in held)


def plainly(batches_, partitions):
    """The same rule with dictionaries."""
    marks, passed, waiting, out, offset = {}, {}, [], [], 0
    for k, events in enumerate(batches_):
        for t, p, e in events:
            if isinstance(e, str):
                at = json.loads(e)
                at = int(str(at.get("resolved") or at["payload"]["resolved"]).split(".")[0])
                marks[t, p] = max(at, marks.get((t, p), 0))
            else:
                waiting.append((offset, t, e))
            offset += 1
        for t in {t for t, _ in marks}:
            own = [m for (u, _), m in marks.items() if u == t]
            if len(own) >= partitions.get(t, 0):
                passed[t] = max(passed.get(t, 0), min(own))
        out += [(k, o) for o, t, e in waiting if e <= passed.get(t, -1)]
        waiting = [w for w in waiting if w[2] > passed.get(w[1], -1)]
    return sorted(out), sorted(o for o, _, _ in waiting)


@pytest.mark.parametrize("seed", range(2))
def test_released_once_in_the_right_batch(spark, tmp_path, seed):
    rng = random.Random(seed)
    made, low = [], 0
    for _ in range(5):
        events = [(rng.choice("ab"), rng.randrange(3), rng.randrange(low, low + 60)) for _ in range(25)]
        events += [(rng.choice("ab"), rng.randrange(3), mark(rng.choice([t := rng.randrange(low, low + 40), f"{t}.0000000001"]), rng.random() < 0.5)) for _ in range(3)]
        rng.shuffle(events)
        made.append(events)
        low += 15
    wanted = plainly(made, {"a": 3})
    assert wanted[0]
    assert batches(spark, tmp_path, made, retry=(1, 3), partitions={"a": 3}) == wanted


def test_a_new_partition_does_not_move_the_frontier_back(spark, tmp_path):
    made = [[("a", 0, 5), ("a", 0, mark(20))], [("a", 1, mark(3)), ("a", 1, 15)], [("a", 0, 30), ("a", 1, mark(40)), ("a", 0, mark(25))]]
    assert batches(spark, tmp_path, made) == ([(0, 0), (1, 3)], [4]) == plainly(made, {})


def test_a_missing_partition_holds_everything(spark, tmp_path):
    made = [[("a", 0, 5), ("a", 0, mark(20))], [("a", 1, mark(9))]]
    assert batches(spark, tmp_path, made, partitions={"a": 2}) == ([(1, 0)], [])


def test_a_stalled_frontier_reads_no_held_rows_and_nothing_is_joined(spark, tmp_path, monkeypatch):
    release = FrontierRelease(str(tmp_path / "r"), width=10)
    raw = log(spark, [("a", 0, 5), ("a", 0, 50), ("a", 0, mark(20))])
    release.write_batch(raw, data(raw), 0)
    monkeypatch.setattr(FrontierRelease, "held", lambda *_: pytest.fail("held rows were read"))
    joined = []
    monkeypatch.setattr(type(raw), "join", lambda *a, **_: joined.append(a))
    later = log(spark, [("a", 0, 60)], 3)
    release.write_batch(later, data(later), 1)
    assert not joined


def test_hybrid_times(spark):
    texts = ["1700000000000000000.0000000007", "1700000000000000000", "17.00000000001", "x", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(hybrid_time(F.col("t"))).collect()] == [Decimal(texts[0]), Decimal("1700000000000000000.0000000000"), None, None, None]
    events = [{"ts_ns": 5_000_001}, {"source": {"ts_hlc": "5000002.0000000001"}, "ts_ns": 1}, {"updated": "5000002.0000000000"}, {}]
    frame = spark.createDataFrame([(i, json.dumps(e)) for i, e in enumerate(events)], "i int, e string")
    got = frame.select("i", event_clock(F.try_parse_json("e"), F.lit(5).cast("bigint")).alias("at")).orderBy("at")
    assert [r.i for r in got.collect()] == [3, 0, 2, 1]
    clock = progress(log(spark, [("a", 0, mark("20.0000000002")), ("a", 0, mark("20.0000000010", True))])).head()
    assert (clock.frontier, clock.clock) == (20, Decimal("20.0000000010"))
