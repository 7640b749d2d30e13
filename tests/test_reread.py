"""Re-reads in chunks against a replay of the log, and comparison in two levels against the plain one."""

import random

from pyspark.sql import functions as F

from tideline.operators import reread as RR
from tideline.operators import verify as V
from tideline.operators.apply import apply_changes

CHANGES = "id long, op string, v string, offset long"


def test_state_equals_the_source(spark):
    """A source table changes while its log, from which every fifth change was lost, is mended by chunked re-reads."""
    rng = random.Random(3)
    source, log, marks, reread, chunk = {}, [], [], [], 0
    opened = None
    for at in range(1, 400):
        if at % 20 == 0:
            chunk = at // 40 % 5
            if at % 40 == 0:  # low mark; the rows are read somewhere before the high mark
                marks.append((chunk, RR.OPEN, at))
                opened = at + rng.randrange(1, 19)
            else:
                marks.append((chunk, RR.CLOSE, at))
        else:
            key = rng.randrange(25)
            op = rng.choice("cud") if key in source else "c"
            if op == "d":
                del source[key]
            else:
                source[key] = f"{key}@{at}"
            if rng.random() < 0.8 or at > 198:  # lost changes are early ones
                log.append((key, op, source.get(key), at))
        if opened == at:
            reread = [r for r in reread if r[0] // 5 != chunk] + [(k, v) for k, v in source.items() if k // 5 == chunk]
    changes = spark.createDataFrame(log, CHANGES)
    rows = spark.createDataFrame(reread, "id long, v string")
    marks = spark.createDataFrame(marks, "chunk long, type string, offset long")
    all_rows = RR.with_rereads(changes, rows, marks, ["id"], F.expr("id div 5"))
    got = {r.id: r.v for r in apply_changes(None, all_rows, ["id"], ["offset"]).collect()}
    assert {k: got.get(k) for k in source} == source


def test_windows_and_order(spark):
    marks = spark.createDataFrame([(0, RR.OPEN, 10), (0, RR.CLOSE, 20), (1, RR.OPEN, 30), (1, RR.CLOSE, 5)], "chunk long, type string, offset long")
    assert [tuple(r) for r in RR.windows(marks).collect()] == [(0, 10, 20)]
    changes = spark.createDataFrame([(1, "u", "old", 3), (2, "u", "between", 15), (3, "d", None, 25), (4, "d", None, 12), (11, "u", "x", 1)], CHANGES)
    reread = spark.createDataFrame([(1, "r"), (2, "r"), (3, "r"), (4, "r"), (11, "r")], "id long, v string")
    rows = RR.placed(reread, changes, marks, ["id"], F.expr("id div 10"))
    assert sorted((r.id, r.op, r.offset) for r in rows.collect()) == [(1, "r", 20), (3, "r", 20)]
    state = apply_changes(None, RR.with_rereads(changes, reread, marks, ["id"], F.expr("id div 10")), ["id"], ["offset"])
    assert sorted((r.id, r.v) for r in state.collect()) == [(1, "r"), (2, "between"), (11, "x")]


def test_unknown_requests_are_reported(spark):
    asked = '{"data-collections": ["db.public.orders", "db.public.nothing"]}'
    signals = spark.createDataFrame([("s", "execute-snapshot", asked), ("t", "log", asked)], "id string, type string, data string")
    assert sorted(tuple(r) for r in RR.requests(signals, ["public.orders"]).collect()) == [("s", "public.nothing", False), ("s", "public.orders", True)]


def test_two_levels_equal_one(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(200), rng.choice(["a", None, "b"]), rng.choice([None, 1, 2])) for _ in range(300)]
    other = [r for r in rows if rng.random() < 0.95] + [(500, "new", None)]
    other = [(k, "z", v) if k == 7 else (k, s, v) for k, s, v in other]
    a, b = (spark.createDataFrame(x, "id long, s string, v int") for x in (rows, other))
    want = sorted(map(tuple, V.row_diff(a, b, ["id"]).collect()))
    assert want
    for slices in (1, 16, 4096):
        assert sorted(map(tuple, V.row_diff_by_slice(a, b, ["id"], slices).collect())) == want


def test_equal_tables_shuffle_sums_only(spark, tmp_path):
    rows = spark.range(20_000).select("id", (F.col("id") % 7).cast("string").alias("s"))
    for name, n in (("a", 3), ("b", 5)):
        rows.repartition(n, "s").write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / x)) for x in "ab")
    assert V.differing_slices(a, b, ["id"], 64).count() == 0
    plan = V.row_diff_by_slice(a, b, ["id"], 64)._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and "FileScan" not in plan
    empty = a.limit(0)
    assert V.row_diff_by_slice(empty, empty, ["id"], 64).count() == 0
    assert V.row_diff_by_slice(a, empty, ["id"], 64).count() == 20_000
