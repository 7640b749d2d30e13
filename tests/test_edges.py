"""Inputs that must not be lost, rounded or mistaken."""

import pytest
from pyspark.sql import functions as F
from tests.helpers import NARROW, raw, rows, value

from tideline.functions.decode import decimal_from_text
from tideline.operators import apply as A
from tideline.operators import metrics as M
from tideline.operators import verify as V
from tideline.operators.classify import drop_tombstones
from tideline.operators.route import merge_partitions, rename_topics, stamp_topic
from tideline.plans import flow
from tideline.spec import FlowSpec, Step


@pytest.mark.parametrize(
    ("pattern", "line"),
    [("m_[a-zA-Z0-9_]+_total", "m_abc_total: 5"), ("ab?c<x>", "ac<x>: 5"), ("(?i)LAG", "lag: 5"), ("a(b|cd)e|zz", "zz: 5"), ("x{0}yes", "yes: 5"), ("[^]]+tail", "xtail: 5")],
)
def test_rules_match_what_their_pattern_matches(spark, pattern, line):
    lines = spark.createDataFrame([(line,)], "line string")
    assert M.extract_metrics(lines, "line", [M.MetricRule(pattern, "found")]).count() == 1


def test_rate_uses_the_windows_own_length(spark):
    samples = spark.createDataFrame([("a", 0, 300.0), ("a", 299, 0.0)], "g string, s int, increase double").withColumn("ts", F.timestamp_seconds("s"))
    assert [r.per_second for r in M.windowed_rate(samples, ["g"], width="5 minutes").collect()] == [1.0]


@pytest.mark.parametrize("chunk", [3600, 60])
def test_trailing_rate(spark, chunk):
    at = [0, 10, 59, 60, 61, 130, 3590, 3600, 3649, 3650, 7200]
    samples = spark.createDataFrame([("a", s, float(i + 1)) for i, s in enumerate(at)], "g string, s int, increase double").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.s: r.increase for r in M.trailing_rate(samples, ["g"], chunk_seconds=chunk).withColumn("s", F.unix_seconds("ts")).collect()}
    assert got == {s: sum(j + 1.0 for j, t in enumerate(at) if s - 60 < t <= s) for s in at}


@pytest.mark.parametrize(
    ("text", "want"),
    [("1.005", None), ("1.50", "1.50"), ("1.5000", "1.50"), ("7", "7.00"), ("-0.10", "-0.10"), ("1e2", "100.00"), ("1e-3", None), ("12345678901.00", None), ("x", None), (None, None)],
)
def test_decimals_are_exact_or_bad(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(decimal_from_text(F.col("t"), "decimal(12,2)").cast("string").alias("d")).head().d
    assert got == want


def test_null_unique_keys_never_conflict(spark):
    target = spark.createDataFrame([(1, None), (2, "a")], "id int, email string")
    new = spark.createDataFrame([(3, None), (4, None), (5, "a"), (6, "b"), (7, "b")], "id int, email string")
    assert rows(A.insert_if_absent(target, new, ["email"], ["id"]), "id") == [(1,), (2,), (3,), (4,), (6,)]


def test_transfers_to_unknown_accounts_keep_the_total(spark):
    balances = spark.createDataFrame([(1, 10)], "id int, balance int").withColumn("balance", F.col("balance").cast("decimal(12,2)"))
    moves = spark.createDataFrame([(1, 9, 4)], "payer int, payee int, amount int").withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    assert {r.id: int(r.balance) for r in A.transfer(balances, moves).collect()} == {1: 6, 9: 4}


def test_marks_may_be_wrapped_or_decimal(spark):
    log = raw(spark, [(None, '{"resolved": 5}'), (None, '{"payload": {"resolved": "1700000000000000000.0000000007"}}'), ({"id": 1}, value("c", {"id": 1}))])
    assert A.progress(log).head().frontier == 1700000000000000000


def test_missing_tables_show_in_joined_counts(spark):
    counts = spark.createDataFrame([("a", 1), ("c", 3)], "table_name string, n long")
    assert V.joined_counts(counts, ["a", "b", "c"]).head().fingerprint == "1|?|3"


def test_blank_values_are_tombstones(spark):
    assert drop_tombstones(raw(spark, [({"id": 1}, "\t\n "), ({"id": 1}, None), ({"id": 1}, "{}")])).count() == 1


# Flows ------------------------------------------------------------------------------------------


def test_gated_steps_read_the_input_once(spark):
    log = raw(spark, [({"id": i}, value("c", {"id": i})) for i in range(6)] + [({"id": 9}, None)])
    gate = F.col("offset") % 2 == 0
    steps = [Step(f"s{k}", stamp_topic, {}, gate & (F.col("offset") < 4)) for k in range(2)] + [Step("drop", drop_tombstones, {}, F.col("offset") == 6)]
    plan = flow.chain(log, steps)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    stamped = flow.chain(log, steps[:1])
    new = [c for c in stamped.columns if c not in log.columns][0]
    assert {r["offset"] for r in stamped.filter(F.col(new).isNotNull()).collect()} == {0, 2}
    assert flow.chain(log, steps[2:]).count() == 6


def test_merged_topics_are_ordered_by_event_time(spark):
    old = raw(spark, [({"id": 1}, value("c", {"id": 1, "amount": "1.00"}, ts_ms=1))] * 3 + [({"id": 1}, value("d", before={"id": 1}, ts_ms=2))], topic="shop.public.orders_2024_01")
    new = raw(spark, [({"id": 1}, value("c", {"id": 1, "amount": "2.00"}, ts_ms=3))], topic="shop.public.orders_2024_02")
    declared = FlowSpec(
        transforms=[Step("merge", merge_partitions, {"pattern": r"shop\.public\.orders_.*", "target": "shop.public.orders"})],
        tables={"orders": NARROW},
        table_template="${source.table}",
    )
    out = flow.run_batch(old.union(new), declared)["orders"]
    assert [str(r.amount) for r in out.collect()] == ["2.00"]


def test_rows_without_a_declared_table_are_kept_aside(spark, tmp_path):
    log = raw(spark, [({"id": 1}, value("c", {"id": 1, "amount": "1.00"}))]).union(raw(spark, [({"id": 2}, value("c", {"id": 2}))], topic="shop.public.other"))
    declared = FlowSpec(tables={"orders": NARROW}, table_template="${source.table}")
    assert [r.reason for r in flow.unknown_rows(log, declared).collect()] == ["unknown_table"]
    log.write.parquet(f"{tmp_path}/log")
    stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/log")
    query, tables = flow.run_stream(stream, declared, f"{tmp_path}/out")
    query.awaitTermination()
    assert tables["orders"].read(spark).count() == 1
    assert spark.read.parquet(flow.quarantine_path(f"{tmp_path}/out", flow.UNKNOWN_TABLE)).count() == 1


def test_source_names_survive_a_rename(spark):
    own = [({"id": 1}, value("c", {"id": 1, "amount": "1.00"}, wrapped=w, source={"schema": "public", "table": "orders"})) for w in (True, False)]
    log = raw(spark, own, topic="renamed.before.it_came").union(raw(spark, [({"id": 2}, value("c", {"id": 2, "amount": "2.00"}))]))
    declared = FlowSpec(
        transforms=[Step("short", rename_topics, {"pattern": r".*\.(.*)", "replacement": "$1"})], tables={"public_orders": NARROW}, table_template="${source.schema}_${source.table}"
    )
    assert [r.target for r in flow.prepared(log, declared).collect()] == ["public_orders"] * 3
    assert flow.run_batch(log, declared)["public_orders"].count() == 2
