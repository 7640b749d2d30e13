"""Scenarios with known outcomes: small logs whose final state is written down."""

from decimal import Decimal

import pytest
from tests.helpers import NARROW, raw, rows, value
from pyspark.sql import functions as F

from tideline.operators import apply as A
from tideline.operators import audit as Q
from tideline.operators import graph as G
from tideline.operators import history as H
from tideline.operators import metrics as M
from tideline.operators import route as R
from tideline.operators import verify as V
from tideline.operators.classify import classify
from tideline.plans import flow
from tideline.sources import logs
from tideline.spec import Col, FlowSpec, TableSpec


def narrow(i, name, amount):
    return {"id": i, "name": name, "amount": amount}


def mirror(df, spec=NARROW):
    return A.apply_changes(None, flow.flat_changes(df, spec), spec.keys, ["partition", "offset"])


def test_embedded_scenario(spark):
    seed = [(1, "Alice", "100.00"), (2, "Bob", "200.50"), (3, "Carol", "320.00")]
    events = [({"id": i}, value("r", narrow(i, n, a))) for i, n, a in seed]
    events += [
        ({"id": 4}, value("c", narrow(4, "Dave", "50.00"))),
        ({"id": 1}, value("u", narrow(1, "Alice", "999.00"), narrow(1, "Alice", "100.00"))),
        ({"id": 2}, value("d", None, narrow(2, "Bob", "200.50"))),
        ({"id": 2}, None),
    ]
    got = mirror(raw(spark, events))
    assert rows(got) == [(1, "Alice", Decimal("999.00")), (3, "Carol", Decimal("320.00")), (4, "Dave", Decimal("50.00"))]


ORDER = TableSpec(
    "orders",
    ("order_number",),
    (
        Col("order_number"),
        Col("amount", "decimal(12,2)", "decimal"),
        Col("status"),
        Col("precise_qty", "decimal(28,18)", "decimal"),
        Col("priority", default="normal"),
    ),
)


def order(number, amount, status, **more):
    return {"order_number": number}, {"order_number": number, "amount": amount, "status": status, **more}


def lake_events():
    seed = [("ORD-1001", "129.99", "confirmed", "9999999999.999999999"), ("ORD-1002", "249.50", "pending", "0.000000000000000001"), ("ORD-1003", "34.99", "shipped", "0.0")]
    events = []
    for n, a, s, q in seed:
        k, after = order(n, a, s, precise_qty=q)
        events.append((k, value("r", after, ts_ms=1)))
    k, after = order("ORD-LIVE-001", "75.25", "new", precise_qty="1234567890.123456789")
    events.append((k, value("c", after, ts_ms=2)))
    k, after = order("ORD-1002", "249.50", "shipped", precise_qty="0.000000000000000001")
    events.append((k, value("u", after, ts_ms=3)))
    events += [({"order_number": "ORD-1003"}, value("d", ts_ms=4)), ({"order_number": "ORD-1003"}, None)]
    return events


def test_lake_scenario(spark, tmp_path):
    data, _, bad = classify(raw(spark, lake_events()), ORDER)
    assert bad.count() == 0
    path = str(tmp_path / "orders")
    H.append_history(R.flatten(data, ORDER), path)
    history = H.read_history(spark, path)
    assert V.missing_columns(history, ["__op", "__deleted"]) == []
    assert rows(V.op_histogram(history)) == [("c", 1), ("d", 1), ("r", 3), ("u", 1)]
    assert V.has_exact(history, "precise_qty", "9999999999.999999999", "decimal(28,18)").head().present
    view = H.latest_view(history, ["order_number"], [F.col("__ts_ms").desc(), F.col("offset").desc()])
    assert rows(view, "order_number", "status") == [("ORD-1001", "confirmed"), ("ORD-1002", "shipped"), ("ORD-LIVE-001", "new")]


def test_missing_delete_flag_means_live(spark):
    history = spark.createDataFrame([(1, 5, None)], "id int, __ts_ms long, __deleted string")
    assert H.latest_view(history, ["id"], [F.col("__ts_ms").desc()]).count() == 1


def test_schema_evolution_and_resnapshot(spark):
    events = lake_events()
    k, after = order("ORD-SCHEMA-001", "55.00", "new", priority="high")
    events.append((k, value("c", after)))
    k, after = order("ORD-LIVE-001", "75.25", "new", priority="urgent")
    events.append((k, value("u", after)))
    got = mirror(raw(spark, events), ORDER)
    assert rows(got, "order_number", "priority") == [("ORD-1001", None), ("ORD-1002", None), ("ORD-LIVE-001", "urgent"), ("ORD-SCHEMA-001", "high")]

    signals = logs.literal(spark, [("s1", "execute-snapshot", '{"data-collections": ["shopdb.public.orders"]}'), ("s2", "log", "{}")], "id string, type string, data string")
    reread = A.resnapshot(signals, {"public.orders": lambda: got, "public.customers": lambda: got})
    assert reread["public.orders"].filter("op = 'r'").count() == 4
    assert set(reread) == {"public.orders"}
    again = flow.flat_changes(raw(spark, events), ORDER).unionByName(
        reread["public.orders"].withColumn("partition", F.lit(0)).withColumn("offset", F.lit(10**6).cast("bigint"))
    )
    assert V.row_diff(got, A.apply_changes(None, again, ["order_number"], ["partition", "offset"]), ["order_number"]).count() == 0


def test_reread_row_loses_to_change_in_window(spark):
    snapshot = spark.createDataFrame([(1, "old"), (2, "old")], "id int, v string")
    changes = spark.createDataFrame([(1, 15), (2, 5)], "id int, offset int")
    kept = A.drop_overtaken(snapshot, changes, ["id"], F.col("offset").between(10, 20))
    assert rows(kept) == [(2, "old")]


def test_other_schema(spark):
    quotes = TableSpec("quotes", ("part", "nation"), (Col("part", "bigint", "int"), Col("nation", "bigint", "int"), Col("price", "decimal(9,3)", "decimal")), "purchasing")
    topic, table = "shop.purchasing.quotes", "purchasing_quotes"
    events = [({"part": p, "nation": n}, value("r", {"part": p, "nation": n, "price": f"{p}.{n:03}"})) for p in (7, 8) for n in (1, 2, 3)]
    events += [({"part": 7, "nation": 2}, value("d")), ({"part": 8, "nation": 1}, value("u", {"part": 8, "nation": 1, "price": "0.5"}))]
    declared = FlowSpec(topics=(topic,), tables={table: quotes}, table_template="${source.schema}_${source.table}")
    got = flow.run_batch(raw(spark, events, topic=topic), declared)[table]
    assert [(p, n, str(v)) for p, n, v in rows(got)] == [(7, 1, "7.001"), (7, 3, "7.003"), (8, 1, "0.500"), (8, 2, "8.002"), (8, 3, "8.003")]


def graph_logs(spark, with_updates=False, with_deletes=False):
    people = [(1, "c", "Alice", "standard"), (2, "c", "Bob", "standard"), (3, "c", "Carol", "premium")]
    orders = [(101, "c", 1, "199.99", "new"), (102, "c", 1, "75.50", "new"), (103, "c", 2, "320.00", "new"), (104, "c", 3, "42.25", "new")]
    if with_updates:
        orders.append((101, "u", 1, "199.99", "shipped"))
        people.append((2, "u", "Bob", "gold"))
    if with_deletes:
        orders.append((104, "d", None, None, None))
        people.append((3, "d", None, None))
    c = spark.createDataFrame([(*p, 100 + i, "c", i) for i, p in enumerate(people)], "id long, op string, name string, tier string, ts_ms long, topic string, offset long")
    o = spark.createDataFrame([(*p, 100 + i, "o", i) for i, p in enumerate(orders)], "id long, op string, customer_id long, amount string, status string, ts_ms long, topic string, offset long")
    return c, o


def built(c, o, mode="accumulate"):
    people = G.nodes_with_placeholders(c, G.references(o, "customer_id"), ["name", "tier"])
    return people, G.nodes(o, ["amount", "status"]), G.edges(o, "customer_id", c, mode)


def test_graph_scenario(spark):
    people, orders, edges = built(*graph_logs(spark))
    assert (people.count(), orders.count(), edges.count()) == (3, 4, 4)
    assert G.degree(edges).filter("src = 1").head().degree == 2
    people, orders, edges = built(*graph_logs(spark, with_updates=True))
    assert orders.filter("id = 101").head().status == "shipped" and people.filter("id = 2").head().tier == "gold"
    people, orders, edges = built(*graph_logs(spark, with_updates=True, with_deletes=True))
    assert (people.count(), orders.count(), edges.count()) == (2, 3, 3)


def test_partition_scenario(spark):
    base = logs.grid(spark.range(1, 4), {"month": (F.lit(1), F.lit(3)), "copy": (F.lit(1), F.col("id").cast("int"))})
    day = F.make_date(F.lit(2025), "month", F.lit(9))
    orders = base.select(
        F.concat(F.lit("app.sales.orders_"), F.date_format(day, "yyyy_MM")).alias("topic"),
        F.concat_ws("-", "month", "id", "copy").alias("order_number"),
        F.lit("open").alias("status"),
        day.alias("created_at"),
    )
    assert orders.count() == 18
    assert rows(V.partition_distribution(orders, "topic").select("n").distinct()) == [(6,)]
    assert Q.range_violations(orders.withColumn("part", F.substring_index("topic", ".", -1)), "created_at", "part", "orders_").count() == 0
    target = R.merge_partitions(orders, r"app\.sales\.orders_.*", "app.sales.orders").drop("topic")
    edits = logs.literal(
        spark,
        [("1-1-1", "closed", "u", 1), ("2-3-2", "closed", "u", 2), ("3-4-1", "open", "c", 3), ("3-3-3", None, "d", 4)],
        "order_number string, status string, op string, offset int",
    )
    got = A.apply_changes(target, edits, ["order_number"], ["offset"])
    assert got.count() == 18 and got.filter("status = 'closed'").count() == 2
    people = logs.literal(spark, [(n, f"{n}@example.com", i) for i, n in enumerate(["alice", "bob", "carol", "dan", "eve"])], "name string, email string, id int")
    new = logs.literal(spark, [("frank", "frank@example.com", 9), ("alice", "alice@example.com", 10), ("frank2", "frank@example.com", 11)], "name string, email string, id int")
    merged = A.insert_if_absent(people, new, ["email"], ["id"])
    assert merged.count() == 6 and merged.filter("name = 'frank'").count() == 1


def test_transfer_scenario(spark):
    accounts = spark.range(1, 1001).select("id", F.lit(0).cast("decimal(12,2)").alias("balance"))
    moves = spark.range(900).select(
        F.col("id").alias("offset"), (F.col("id") * 7 % 1000 + 1).alias("payer"), (F.col("id") * 13 % 1000 + 1).alias("payee"), (F.col("id") % 100 + 1).cast("decimal(12,2)").alias("amount")
    )
    after = A.transfer(accounts, moves)
    assert V.fingerprint(after, "balance").head()[0] == "1000|0.00"
    V.assert_value(V.fingerprint(after, "balance"), "1000|0.00")
    with pytest.raises(AssertionError):
        V.assert_value(V.fingerprint(after, "balance"), "1000|0.01")


def test_compensating_errors_are_found(spark):
    source = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, balance int")
    target = spark.createDataFrame([(1, 11), (2, 19), (4, 30)], "id int, balance int")
    assert V.parity({"t": source}, {"t": target}, "balance").head().equal
    assert rows(V.row_diff(source, target, ["id"])) == [(1, "changed"), (2, "changed"), (3, "missing"), (4, "extra")]


def test_row_diff_sees_moved_nulls_and_repeats(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "y", "z"), (3, "w", "w")], "id int, p string, q string")
    b = spark.createDataFrame([(1, "x", None), (2, "y", "z"), (2, "y", "z"), (3, "w", "w")], "id int, p string, q string")
    assert rows(V.row_diff(a, b, ["id"])) == [(1, "changed"), (2, "changed")]


def test_parity_flags_a_missing_table(spark):
    df = spark.range(3)
    assert rows(V.parity({"a": df, "b": df}, {"a": df}), "table_name", "equal") == [("a", True), ("b", False)]


def test_metric_rules(spark):
    lines = [
        "kafka.connect<type=source-task-metrics, connector=C, task=0><>source-record-write-total: 42.0",
        "kafka.connect<type=connector-metrics, connector=C><>status: running",
        "kafka.connect<type=connect-metrics, client-id=w1><>request-rate: 0.5",
        "cap.P<type=connector-metrics, context=streaming, server=S><>MilliSecondsBehindSource: 17",
        "cap.P<type=connector-metrics, server=S, task=1, context=snapshot, database=D><>TotalRows: 5",
        "cap.P<type=connector-metrics, server=S, task=1, context=snapshot><>TotalRows: 6",
        "cap.P<type=connector-metrics, context=snapshot, server=S, key=public.t><>RowsScanned: 7",
        "nothing here",
    ]
    got = M.extract_metrics(spark.createDataFrame([(x,) for x in lines], "line string"), "line", M.rules_for("cap", "cap_metrics"))
    found = {(r.name, tuple(sorted(r.labels.items())), r.value) for r in got.collect()}
    assert found == {
        ("kafka_connect_source_record_write_total", (("connector", "C"), ("task", "0")), 42.0),
        ("kafka_connect_connector_status", (("connector", "C"), ("status", "running")), 1.0),
        ("kafka_connect_metrics_request_rate", (("client", "w1"),), 0.5),
        ("cap_metrics_MilliSecondsBehindSource", (("context", "streaming"), ("name", "S"), ("plugin", "P")), 17.0),
        ("cap_metrics_TotalRows", (("context", "snapshot"), ("database", "D"), ("name", "S"), ("plugin", "P"), ("task", "1")), 5.0),
        ("cap_metrics_TotalRows", (("context", "snapshot"), ("name", "S"), ("plugin", "P"), ("task", "1")), 6.0),
        ("cap_metrics_RowsScanned", (("context", "snapshot"), ("name", "S"), ("plugin", "P"), ("table", "public.t")), 7.0),
    }


def test_rows_route_to_none_one_or_several_tables(spark):
    df = spark.createDataFrame([("shop.public.orders",), ("shop.public.customers",), ("other.shop.public.orders",)], "_topic string")
    parts = R.route(df, "_topic", {"orders": r"shop\.public\.orders", "all": r"shop\..*", "none": "x"})
    assert {n: p.count() for n, p in parts.items()} == {"orders": 1, "all": 2, "none": 0}


def test_requested_key_fields_narrow_to_the_table():
    assert R.key_columns(NARROW, ["id", "created_at"]) == ["id"]
    assert R.key_columns(NARROW) == ["id"]
    with pytest.raises(ValueError):
        R.key_columns(NARROW, ["sku"])


def test_required_text_guards_only_safe_patterns():
    assert M._required_text("kafka.connect<type=a, connector=(.+)><>status: (.+)") == "connect<type=a, connector="
    assert M._required_text("ab*c") == "" and M._required_text("a|b") == ""


def test_number_series(spark):
    assert rows(logs.series(spark, 1, 4)) == [(1,), (2,), (3,), (4,)]
    df = spark.createDataFrame([("a", 2), ("b", 0)], "n string, k long")
    assert rows(logs.series_per_row(df, F.lit(1).cast("bigint"), F.col("k")), "n", "i") == [("a", 1), ("a", 2)]


def test_missing_names(spark):
    found = spark.createDataFrame([("a",)] * 5 + [("b",)], "t string")
    expected = spark.createDataFrame([("a",), ("c",), ("c",)], "t string")
    assert rows(V.missing_names(found, expected, "t")) == [("c",)]


def test_kafka_options_and_jdbc_split():
    assert logs.kafka_options("h:1", topics=["a", "b"])["subscribe"] == "a,b"
    assert logs.kafka_options("h:1", topics_regex="a.*")["subscribePattern"] == "a.*"
    with pytest.raises(ValueError):
        logs.kafka_options("h:1")
    assert logs.jdbc_partition_options("id", 1, 9, 4) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}
