"""Laws that must hold for any log, checked on random and on skewed ones."""

import random
from collections import defaultdict
from decimal import Decimal

from tests.helpers import rows
from pyspark.sql import functions as F

from tideline.operators import apply as A
from tideline.operators import graph as G
from tideline.operators import metrics as M
from tideline.operators import verify as V
from tideline.plans.feeds import ORDERS, ORDERS_SPEC, Lake
from tideline.plans.flow import flat_changes
from tideline.sources.logs import read_log
from tideline.streaming import run
from tideline.streaming.mirror import MirrorTable

SCHEMA = "id long, v string, op string, offset long"


def random_log(seed, n=400, keys=25):
    """A third of the events belong to key 0."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if rng.random() < 1 / 3 else rng.randrange(keys)
        op = rng.choice("cuurd")
        out.append((key, None if op == "d" else f"v{rng.randrange(9)}", op, i))
    return out


def replay(log, start=None):
    state = dict(start or {})
    for key, v, op, _ in sorted(set(log), key=lambda e: e[3]):
        if op == "d":
            state.pop(key, None)
        else:
            state[key] = v
    return sorted(state.items())


def applied(spark, log, target=None):
    return rows(A.apply_changes(target, spark.createDataFrame(log, SCHEMA), ["id"], ["offset"]))


def test_apply_equals_replay_in_any_arrival_order(spark):
    for seed in range(3):
        log = random_log(seed)
        want = replay(log)
        assert sorted(applied(spark, log)) == want
        shuffled = log[:]
        random.Random(seed).shuffle(shuffled)
        assert sorted(applied(spark, shuffled + shuffled[:100])) == want


def test_prefix_then_suffix(spark):
    log = random_log(7)
    first = A.apply_changes(None, spark.createDataFrame(log[:150], SCHEMA), ["id"], ["offset"])
    assert sorted(applied(spark, log[150:], first)) == replay(log)


def test_mirror_table_batches_retries_and_compaction(spark, tmp_path):
    log = random_log(11)
    table = MirrorTable(str(tmp_path / "m"), ("id",), ("offset",))
    cut = [log[:100], log[100:220], log[220:300], log[300:]]
    for i, part in enumerate(cut[:2]):
        table.write_batch(spark.createDataFrame(part, SCHEMA), i)
    table.write_batch(spark.createDataFrame(cut[1], SCHEMA), 1)
    assert sorted(rows(table.read(spark))) == replay(log[:220])
    assert table.compact(spark) == 1
    assert sorted(rows(table.read(spark))) == replay(log[:220])
    table.write_batch(spark.createDataFrame(cut[3], SCHEMA), 2)
    table.write_batch(spark.createDataFrame(cut[2], SCHEMA), 3)
    table.write_batch(spark.createDataFrame(log[:220], SCHEMA), 4)
    assert sorted(rows(table.read(spark))) == replay(log)
    assert table.compact(spark) == 4
    assert sorted(rows(table.read(spark))) == replay(log)


def test_mirror_table_gains_columns(spark, tmp_path):
    table = MirrorTable(str(tmp_path / "m"), ("id",), ("offset",))
    table.write_batch(spark.createDataFrame([(1, "a", "c", 0), (2, "b", "c", 1)], SCHEMA), 0)
    table.compact(spark)
    table.write_batch(spark.createDataFrame([(2, "c", "u", 2, "high")], SCHEMA + ", priority string"), 1)
    assert rows(table.read(spark), "id", "v", "priority") == [(1, "a", None), (2, "c", "high")]


def test_batch_equals_stream(spark, tmp_path):
    lake = Lake(spark, "/root/testdata/sf0.001")
    table = MirrorTable(str(tmp_path / "m"), ("id",), ("partition", "offset"))
    stream = read_log(spark, lake.raw_files(5), topics=[ORDERS], streaming=True, max_files_per_trigger=1)
    run.drain(stream, lambda b, i: table.write_batch(flat_changes(b, ORDERS_SPEC), i), str(tmp_path / "c"))
    batch = A.apply_changes(None, flat_changes(lake.order_raw(), ORDERS_SPEC), ["id"], ["partition", "offset"])
    assert V.row_diff(batch, table.read(spark), ["id"]).count() == 0


def test_running_balance_with_a_hot_account(spark):
    rng = random.Random(3)
    entries = [(i, 0 if i % 3 == 0 else rng.randrange(1, 9), Decimal(rng.randrange(-500, 500)) / 100) for i in range(600)]
    df = spark.createDataFrame(entries, "offset long, id long, delta decimal(12,2)")
    totals, want = defaultdict(Decimal), []
    for offset, key, delta in entries:
        totals[key] += delta
        want.append((offset, totals[key]))
    for chunk in (1, 7, 100, 10_000):
        got = A.running_balance(df, "id", "delta", "offset", chunk=chunk).select("offset", "balance").collect()
        assert sorted((r.offset, r.balance) for r in got) == want


def test_counter_increase_over_chunks_and_restarts(spark):
    rng = random.Random(5)
    samples, want, last, value = [], {}, {}, defaultdict(int)
    for t in range(500):
        s = "hot" if t % 3 == 0 else f"s{rng.randrange(4)}"
        value[s] = rng.randrange(5) if rng.random() < 0.05 else value[s] + rng.randrange(20)
        samples.append((s, 1_700_000_000 + t * 97, value[s]))
        if s in last:
            want[(s, t)] = value[s] - last[s] if value[s] >= last[s] else value[s]
        last[s] = value[s]
    df = spark.createDataFrame(samples, "s string, sec long, value long").select("s", F.timestamp_seconds("sec").alias("ts"), "value")
    for seconds in (60, 3600, 30 * 86400):
        got = M.counter_increase(df, ["s"], chunk_seconds=seconds).filter("increase IS NOT NULL")
        found = {(r.s, (r.sec - 1_700_000_000) // 97): r.increase for r in got.select("s", F.unix_seconds("ts").alias("sec"), "increase").collect()}
        assert found == want


def test_counter_series_with_a_null_label(spark):
    df = spark.createDataFrame([("a", None, 10, 1.0), ("a", None, 4000, 4.0), ("a", "0", 20, 7.0)], "c string, task string, sec long, value double")
    got = M.counter_increase(df.withColumn("ts", F.timestamp_seconds("sec")).drop("sec"), ["c", "task"])
    assert rows(got, "task", "value", "increase") == sorted([("0", 7.0, None), (None, 1.0, None), (None, 4.0, 3.0)], key=repr)


def test_counter_samples_are_shuffled_once(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("s"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("value"))
    got = M.counter_increase(df, ["s"], chunk_seconds=10)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("Range (0, 100") == 1, plan


def merged_graph(people, orders):
    """The graph by replaying every event in order, one at a time."""
    nodes, placed = {}, set()
    log = [(e[-3:], "person", e) for e in people] + [(e[-3:], "order", e) for e in orders]
    order_nodes = {}
    for _, kind, e in sorted(log, key=lambda x: x[0]):
        if kind == "person":
            key, op, name = e[0], e[1], e[2]
            if op == "d":
                nodes.pop(key, None)
                placed = {p for p in placed if p[0] != key}
            else:
                nodes[key] = name
        else:
            key, op, customer = e[0], e[1], e[2]
            if op == "d":
                order_nodes.pop(key, None)
                placed = {p for p in placed if p[1] != key}
            else:
                order_nodes[key] = customer
                nodes.setdefault(customer, None)
                placed.add((customer, key))
    return nodes, order_nodes, placed


def test_graph_equals_event_by_event_replay(spark):
    for seed in range(4):
        rng = random.Random(seed)
        people, orders = [], []
        for i in range(300):
            ts = rng.randrange(120)
            if rng.random() < 0.4:
                op = rng.choice("cud")
                people.append((rng.randrange(6), op, None if op == "d" else f"n{i}", ts, "c", i))
            else:
                op = rng.choice("ccud")
                customer = None if op == "d" else (0 if rng.random() < 1 / 3 else rng.randrange(8))
                orders.append((rng.randrange(20), op, customer, ts, "o", i))
        c = spark.createDataFrame(people, "id long, op string, name string, ts_ms long, topic string, offset long")
        o = spark.createDataFrame(orders, "id long, op string, customer_id long, ts_ms long, topic string, offset long")
        nodes, order_nodes, placed = merged_graph(people, orders)
        got = G.nodes_with_placeholders(c, G.references(o, "customer_id"), ["name"])
        assert {r.id: r.name for r in got.collect()} == nodes
        assert {r.id: r.customer_id for r in G.nodes(o, ["customer_id"]).collect()} == order_nodes
        assert {(r.src, r.dst) for r in G.edges(o, "customer_id", c).collect()} == placed
        current = {(r.src, r.dst) for r in G.edges(o, "customer_id", c, "current").collect()}
        assert current == {(s, d) for s, d in placed if order_nodes[d] == s}


def test_frontier_waits_for_every_partition(spark):
    raw = spark.createDataFrame(
        [("t", 0, 1, None, None, '{"resolved": 50}'), ("t", 1, 1, None, None, '{"resolved": 30}'), ("t", 1, 2, None, None, '{"resolved": 40}'), ("u", 0, 1, None, None, '{"resolved": 9}'), ("u", 1, 1, None, None, "{}")],
        "topic string, partition int, offset long, ts timestamp, key string, value string",
    )
    marks = run.frontier(raw)
    assert rows(marks) == [("t", 40), ("u", None)]
    data = spark.createDataFrame([("t", 40), ("t", 41), ("u", 1)], "topic string, ts_ms long")
    assert rows(run.released(data, marks)) == [("t", 40)]
