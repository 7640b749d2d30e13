"""Queries that reduce and apply logs (A), and the relational steps around them (J, W, O, U, X)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.values import money_text, pick, stable_uuid
from tideline.operators import apply as A
from tideline.operators import classify as C
from tideline.operators import history as H
from tideline.operators import metrics as M
from tideline.operators import reread as RR
from tideline.operators import route as R
from tideline.operators import verify as V
from tideline.operators.audit import fk_violations
from tideline.plans import flow
from tideline.plans.feeds import (
    CUSTOMERS_SPEC,
    ORDERS_SPEC,
    SUPPLIERS_SPEC,
    Lake,
    metric_sql,
    order_sql,
    shop_sql,
)
from tideline.plans.registry import query

POS = ["offset"]


def changes(lake: Lake) -> DataFrame:
    """Order changes as they are applied: key, values, op and offset."""
    return lake.order_changes().select("id", "op", "customer_id", "amount", "status", "offset")


def source_rows(lake: Lake) -> DataFrame:
    return lake.table("orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )


# A: apply ----------------------------------------------------------------------------------------


@query(
    "a01_reduce_latest",
    order_sql("""
SELECT id, op, customer_id, amount, status, seq AS "offset" FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM ch) WHERE rn = 1"""),
)
def reduce_latest(lake: Lake) -> DataFrame:
    return A.reduce_latest(changes(lake), ["id"], POS)


_LINES = """
SELECT order_id, line, part_id, supplier_id, quantity, price FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, line ORDER BY shipped_at DESC, part_id DESC, supplier_id DESC, quantity DESC, price DESC) AS rn
  FROM (SELECT l_orderkey AS order_id, l_linenumber AS line, CASE WHEN l_returnflag = 'R' THEN 'd' ELSE 'u' END AS op, l_shipdate AS shipped_at,
    l_partkey AS part_id, l_suppkey AS supplier_id, CAST(l_quantity AS DECIMAL(12,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS price FROM lineitem))
WHERE rn = 1 AND op <> 'd'"""


@query("a01_reduce_composite_key", _LINES)
def reduce_lines(lake: Lake) -> DataFrame:
    latest = A.reduce_latest(lake.line_changes(), ["order_id", "line"], Lake.LINE_POS)
    return latest.filter("op <> 'd'").drop("op", "shipped_at")


@query(
    "a02_upsert",
    order_sql("""
SELECT o_orderkey AS id, coalesce(m.customer_id, o_custkey) AS customer_id, coalesce(m.amount, CAST(o_totalprice AS DECIMAL(12,2))) AS amount,
  coalesce(m.status, o_orderstatus) AS status FROM orders LEFT JOIN mirror m ON m.id = o_orderkey"""),
)
def upsert(lake: Lake) -> DataFrame:
    latest = A.reduce_latest(changes(lake), ["id"], POS).filter("op <> 'd'").drop("op", *POS)
    return A.upsert(source_rows(lake), latest, ["id"])


@query(
    "a03_delete",
    order_sql("""
SELECT o_orderkey AS id, o_custkey AS customer_id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM steps WHERE id = o_orderkey AND removed AND NOT reopened)"""),
)
def delete(lake: Lake) -> DataFrame:
    gone = A.reduce_latest(changes(lake), ["id"], POS).filter("op = 'd'")
    absent = gone.select((-1 - F.col("id")).alias("id"))
    return A.delete(source_rows(lake), gone.select("id").unionByName(absent), ["id"]).select("id", "customer_id")


@query("a04_mirror", order_sql("SELECT id, customer_id, amount, status FROM mirror"))
def mirror(lake: Lake) -> DataFrame:
    return A.apply_changes(None, changes(lake), ["id"], POS)


@query("a04_mirror_from_wire", order_sql("SELECT id, customer_id, amount, status FROM mirror"))
def mirror_from_wire(lake: Lake) -> DataFrame:
    rows = flow.flat_changes(lake.order_raw(), ORDERS_SPEC)
    return A.apply_changes(None, rows, ["id"], ["partition", "offset"])


@query(
    "a04_apply_onto_target",
    order_sql("""
SELECT id, customer_id, amount, status FROM mirror UNION ALL
SELECT -1 - c_custkey, c_custkey, CAST(0 AS DECIMAL(12,2)), 'kept' FROM customer"""),
)
def apply_onto_target(lake: Lake) -> DataFrame:
    others = lake.table("customer").select(
        (-1 - F.col("c_custkey")).alias("id"),
        F.col("c_custkey").alias("customer_id"),
        F.lit(0).cast("decimal(12,2)").alias("amount"),
        F.lit("kept").alias("status"),
    )
    return A.apply_changes(source_rows(lake).unionByName(others), changes(lake), ["id"], POS, staging=lake.scratch("reduced"))


@query(
    "a05_dedup",
    order_sql("""
SELECT op, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM (SELECT DISTINCT * FROM ch) GROUP BY op"""),
)
def dedup(lake: Lake) -> DataFrame:
    once = A.dedup(lake.order_changes())
    return once.groupBy("op").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount"))


def order_history(lake: Lake) -> DataFrame:
    data, _, _ = C.classify(lake.order_raw(), ORDERS_SPEC)
    return R.flatten(data, ORDERS_SPEC)


@query(
    "a06_append_history",
    order_sql("""
SELECT op AS __op, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS amount, count(DISTINCT strftime(make_timestamp(ts_ms * 1000), '%Y')) AS years
FROM ch GROUP BY op"""),
)
def append_history(lake: Lake) -> DataFrame:
    path = lake.scratch("history")
    flat = order_history(lake).withColumn("year", F.year(F.timestamp_millis("__ts_ms")))
    H.append_history(flat, path, ["year"])
    return (
        H.read_history(lake.spark, path)
        .groupBy("__op")
        .agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount"), F.count_distinct("year").alias("years"))
    )


@query("a07_latest_view", order_sql("SELECT id, customer_id, amount, status FROM mirror"))
def latest_view(lake: Lake) -> DataFrame:
    view = H.latest_view(order_history(lake), ["id"], [F.col("__ts_ms").desc(), F.col("offset").desc()])
    return view.select("id", "customer_id", "amount", "status")


@query(
    "a08_insert_if_absent",
    """
SELECT c_custkey AS id, c_name AS name, lower(c_name) || '@example.com' AS email FROM customer
UNION ALL SELECT min(1000000 + s_suppkey), min_by(s_name, s_suppkey), 'nation' || s_nationkey || '@example.com' FROM supplier WHERE s_suppkey % 3 > 0 GROUP BY s_nationkey
UNION ALL SELECT 1000000 + s_suppkey, s_name, NULL FROM supplier WHERE s_suppkey % 3 = 0""",
)
def insert_if_absent(lake: Lake) -> DataFrame:
    target = lake.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email")
    )
    by_nation = lake.table("supplier").select(
        (F.lit(1000000) + F.col("s_suppkey")).alias("id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 3 > 0, F.concat(F.lit("nation"), F.col("s_nationkey").cast("string"), F.lit("@example.com"))).alias("email"),
    )
    known = target.withColumn("name", F.lit("ignored"))
    return A.insert_if_absent(target, by_nation.unionByName(known), ["email"], ["id"])


@query(
    "a09_delete_top_k",
    """
SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (
  SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate, o_orderkey LIMIT 100)""",
)
def delete_top_k(lake: Lake) -> DataFrame:
    rows = lake.table("orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus", "o_orderdate")
    left = A.delete_top_k(rows, F.col("o_orderstatus") == "F", [F.col("o_orderdate"), F.col("id")], 100, ["id"])
    return left.select("id")


@query(
    "a10_create_target",
    order_sql("SELECT id, customer_id, amount, status FROM mirror"),
)
def create_target(lake: Lake) -> DataFrame:
    path = lake.scratch("created")
    H.create_target(lake.spark, path, ORDERS_SPEC)
    H.append_history(A.apply_changes(None, changes(lake), ["id"], POS), path)
    return H.read_history(lake.spark, path).select("id", "customer_id", "amount", "status")


@query(
    "a11_evolve",
    """
SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END AS priority FROM orders""",
)
def evolve(lake: Lake) -> DataFrame:
    o = lake.table("orders").withColumnsRenamed({"o_orderkey": "id", "o_orderstatus": "status", "o_orderpriority": "priority"})
    urgent = F.col("priority").isin("1-URGENT", "2-HIGH")
    return H.evolve(o.filter(~urgent).select("id", "status"), o.filter(urgent).select("id", "status", "priority"))


CHUNK = 1000  # keys of orders read again together


@query(
    "a12_resnapshot",
    order_sql(f"""
SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderstatus AS status FROM orders WHERE o_orderkey % {CHUNK} < {CHUNK // 4}
UNION ALL SELECT id, customer_id, amount, status FROM mirror WHERE id % {CHUNK} >= {CHUNK // 4}"""),
)
def resnapshot(lake: Lake) -> DataFrame:
    """Signals from every region ask for orders, which are read again in chunks of keys while the log goes on. Keys of a chunk's first
    quarter changed before its low mark: the re-read row stands. Others changed between the marks or later: the log stands."""
    data = '{"data-collections": ["shopdb.public.orders"]}'
    signals = lake.table("region").select(F.col("r_name").alias("id"), F.lit("execute-snapshot").alias("type"), F.lit(data).alias("data"))
    reread = A.resnapshot(signals, {"public.orders": lambda: source_rows(lake), "public.customers": lambda: lake.table("customer")})["public.orders"]
    return A.apply_changes(None, RR.with_rereads(changes(lake), reread, chunk_marks(lake), ["id"], key_chunk()), ["id"], POS)


def key_chunk() -> Column:
    return F.expr(f"id div {CHUNK}")


def chunk_marks(lake: Lake) -> DataFrame:
    """Marks in the log around the reading of each chunk: before the offsets of its second quarter, and of its last."""
    chunks = lake.table("orders").select(F.expr(f"o_orderkey div {CHUNK}").alias("chunk")).distinct()

    def mark(type_: str, quarter: int) -> Column:
        return F.struct(F.lit(type_).alias("type"), ((F.col("chunk") * CHUNK + quarter * CHUNK // 4) * 20 - 1).alias("offset"))

    return chunks.select("chunk", F.inline(F.array(mark(RR.OPEN, 1), mark(RR.CLOSE, 3))))


@query(
    "a12_reread_rows",
    order_sql(f"""
SELECT o_orderkey // {CHUNK} AS chunk, count(*) AS n, max(((o_orderkey // {CHUNK}) * {CHUNK} + {CHUNK * 3 // 4}) * 20 - 1) AS "offset" FROM orders
WHERE o_orderkey % {CHUNK} < {CHUNK // 4} OR o_orderkey % {CHUNK} >= {CHUNK * 3 // 4} GROUP BY 1"""),
)
def reread_rows(lake: Lake) -> DataFrame:
    """How many rows of each chunk stand at its high mark: all whose key did not change between the marks."""
    rows = RR.placed(source_rows(lake), changes(lake), chunk_marks(lake), ["id"], key_chunk())
    return rows.groupBy(key_chunk().alias("chunk")).agg(F.count("*").alias("n"), F.max("offset").alias("offset"))


@query(
    "a12_requests",
    "SELECT r_name AS id, unnest(['public.orders', 'public.' || lower(r_name)]) AS name, unnest([true, false]) AS known FROM region",
)
def reread_requests(lake: Lake) -> DataFrame:
    """Every region asks for orders and for a table that nobody registered; the latter is reported, not dropped."""
    names = F.array(F.lit("shopdb.public.orders"), F.concat(F.lit("shopdb.public."), F.lower("r_name")))
    signals = lake.table("region").select(
        F.col("r_name").alias("id"), F.lit("execute-snapshot").alias("type"), F.to_json(F.struct(names.alias("data-collections"))).alias("data")
    )
    return RR.requests(signals, ["public.orders", "public.customers"])


@query(
    "a13_batch_write",
    order_sql("SELECT count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM mirror"),
)
def batch_write(lake: Lake) -> DataFrame:
    from tideline.streaming.mirror import MirrorTable

    table = MirrorTable(lake.scratch("batch"), ("id",), ("offset",))
    table.write_batch(changes(lake), 0)
    table.write_batch(changes(lake), 0)
    return table.read(lake.spark).agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount"))


@query(
    "a14_apply_tables",
    shop_sql("""
SELECT 'orders' AS table_name, count(*) AS n FROM mirror UNION ALL SELECT 'customers', count(*) FROM cmirror
UNION ALL SELECT 'suppliers', count(*) FROM smirror"""),
)
def apply_tables(lake: Lake) -> DataFrame:
    logs_by_table = {
        "orders": changes(lake),
        "customers": lake.customer_changes().drop("topic", "partition", "ts_ms"),
        "suppliers": lake.supplier_changes().drop("topic", "partition", "ts_ms"),
    }
    specs = {"orders": ORDERS_SPEC, "customers": CUSTOMERS_SPEC, "suppliers": SUPPLIERS_SPEC}
    return V.table_counts(A.apply_tables(logs_by_table, specs, POS))


@query("a14_other_schema", shop_sql("SELECT supplier_id, nation_id, balance FROM smirror"))
def other_schema(lake: Lake) -> DataFrame:
    return A.apply_changes(None, flow.flat_changes(lake.supplier_raw(), SUPPLIERS_SPEC), ["supplier_id"], ["partition", "offset"])


@query(
    "a15_conditional_update",
    """
SELECT o_orderkey AS id, 'u' AS op, o_orderstatus AS old_status, 'shipped' AS new_status,
  CAST(o_totalprice AS DECIMAL(12,2)) AS old_amount, CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 50 AS DECIMAL(12,2)) AS new_amount
FROM orders WHERE o_orderstatus = 'O'""",
)
def conditional_update(lake: Lake) -> DataFrame:
    sets = {"status": F.lit("shipped"), "amount": (F.col("amount") + 50).cast("decimal(12,2)")}
    rows = A.conditional_update(source_rows(lake), F.col("status") == "O", sets, ["id"])
    return rows.select(
        "id",
        "op",
        F.col("before.status").alias("old_status"),
        F.col("after.status").alias("new_status"),
        F.col("before.amount").alias("old_amount"),
        F.col("after.amount").alias("new_amount"),
    )


_TRANSFER = """
WITH t AS (SELECT o_orderkey AS seq, o_custkey AS payer, -1 - (o_custkey % 25) AS payee, CAST(o_totalprice AS DECIMAL(12,2)) AS amount FROM orders),
e AS (SELECT seq, payer AS id, -amount AS delta FROM t UNION ALL SELECT seq, payee, amount FROM t),
acc AS (SELECT c_custkey AS id, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer UNION ALL SELECT -1 - n_nationkey, 0 FROM nation)"""


@query(
    "a16_transfer",
    f"""{_TRANSFER}
SELECT acc.id, CAST(acc.balance + coalesce(n.net, 0) AS DECIMAL(18,2)) AS balance FROM acc
LEFT JOIN (SELECT id, sum(delta) AS net FROM e GROUP BY id) n ON n.id = acc.id""",
)
def transfer(lake: Lake) -> DataFrame:
    return A.transfer(lake.balances(), lake.transfers())


@query(
    "a17_running_balance",
    f"""{_TRANSFER}
SELECT id, seq AS "offset", CAST(sum(delta) OVER (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS balance FROM e""",
)
def running_balance(lake: Lake) -> DataFrame:
    entries = A.signed_entries(lake.transfers())
    return A.running_balance(entries, "id", "delta", "offset", chunk=5_000).select("id", "offset", "balance")


@query(
    "a18_progress",
    shop_sql("""
SELECT 'shop.public.orders' AS topic, CAST(id % 4 AS INTEGER) AS "partition", max(seq) AS max_offset, max(CASE WHEN kind = 9 THEN ts_ms END) AS frontier,
  CAST(max(CASE WHEN kind = 9 THEN ts_ms END) AS DECIMAL(30,10)) + CASE WHEN id % 4 = 1 THEN CAST('0.0000000003' AS DECIMAL(30,10)) ELSE 0 END AS clock
FROM wire GROUP BY id % 4"""),
)
def progress(lake: Lake) -> DataFrame:
    return A.progress(lake.order_raw())


# J: joins ----------------------------------------------------------------------------------------


@query(
    "j01_inner_join",
    """
SELECT r_name AS region, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def inner_join(lake: Lake) -> DataFrame:
    # Pre-aggregated by nation, so the joins see one row per nation however many customers there are.
    per_nation = lake.table("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("c"))
    nations = lake.table("nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return (
        per_nation.join(nations, "n_nationkey")
        .join(lake.table("region"), "r_regionkey")
        .groupBy(F.col("r_name").alias("region"))
        .agg(F.sum("c").alias("customers"))
    )


@query(
    "j02_semi_join",
    "SELECT o_orderkey AS id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def semi_join(lake: Lake) -> DataFrame:
    debtors = lake.table("customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return lake.table("orders").join(debtors, "o_custkey", "left_semi").select(F.col("o_orderkey").alias("id"))


@query(
    "j03_outer_join_on_label",
    metric_sql("""
SELECT coalesce(v.connector, t.connector, s.connector, c.connector) AS "Connector", version AS "Version", type AS "Type", status AS "Status", class AS "Class"
FROM (SELECT connector, max_by(version, ts) AS version FROM metric WHERE version IS NOT NULL GROUP BY 1) v
FULL JOIN (SELECT connector, max_by(type, ts) AS type FROM metric WHERE type IS NOT NULL GROUP BY 1) t USING (connector)
FULL JOIN (SELECT connector, max_by(status, ts) AS status FROM metric WHERE status IS NOT NULL GROUP BY 1) s USING (connector)
FULL JOIN (SELECT connector, max_by(class, ts) AS class FROM metric WHERE class IS NOT NULL GROUP BY 1) c USING (connector)"""),
)
def outer_join(lake: Lake) -> DataFrame:
    fields = ["version", "type", "status", "class"]
    table = M.connector_table(M.extract_metrics(lake.metric_lines(), "line", M.CONNECT_RULES), fields)
    titles = {"connector": "Connector", "version": "Version", "type": "Type", "status": "Status", "class": "Class"}
    return R.rename_columns(table, titles, list(titles))


@query(
    "j04_foreign_key_join",
    """
SELECT o_orderkey AS id, c_name AS name, c_mktsegment AS segment FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def foreign_key_join(lake: Lake) -> DataFrame:
    parents = lake.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return lake.table("orders").select("o_custkey", F.col("o_orderkey").alias("id")).join(parents, "o_custkey", "left").drop("o_custkey")


@query(
    "j05_optional_match",
    order_sql("SELECT m.id, g.id IS NOT NULL AS deleted_before FROM mirror m LEFT JOIN (SELECT DISTINCT id FROM ch WHERE op = 'd') g ON g.id = m.id"),
)
def optional_match(lake: Lake) -> DataFrame:
    live = A.apply_changes(None, changes(lake), ["id"], POS).select("id")
    gone = changes(lake).filter("op = 'd'").select("id").distinct().withColumn("_hit", F.lit(True))
    return live.join(gone, "id", "left").select("id", F.col("_hit").isNotNull().alias("deleted_before"))


@query(
    "j06_anti_join",
    order_sql("SELECT id, customer_id FROM mirror WHERE customer_id NOT IN (SELECT c_custkey FROM customer)"),
)
def anti_join(lake: Lake) -> DataFrame:
    live = A.apply_changes(None, changes(lake), ["id"], POS)
    return fk_violations(live, "customer_id", lake.table("customer"), "c_custkey").select("id", "customer_id")


@query(
    "j07_scalar_subqueries",
    """
SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers,
  (SELECT count(DISTINCT date_trunc('month', o_orderdate)) FROM orders) AS partitions""",
)
def scalar_subqueries(lake: Lake) -> DataFrame:
    customers = lake.table("customer").agg(F.count("*"))
    return lake.table("orders").agg(
        F.count("*").alias("orders"),
        F.max(customers.scalar()).alias("customers"),
        F.count_distinct(F.date_format("o_orderdate", "yyyy-MM")).alias("partitions"),
    )


# W, O, U -----------------------------------------------------------------------------------------


@query("w01_row_number_keep_one", _LINES)
def row_number_keep_one(lake: Lake) -> DataFrame:
    newest = Window.partitionBy("order_id", "line").orderBy(*[F.col(p).desc() for p in Lake.LINE_POS])
    ranked = lake.line_changes().withColumn("rn", F.row_number().over(newest)).filter("rn = 1 AND op <> 'd'")
    return ranked.drop("rn", "op", "shipped_at")


_RATE = """, s AS (SELECT name, connector, task, ts, max(value) AS value FROM metric WHERE name LIKE '%_total' GROUP BY 1, 2, 3, 4),
d AS (SELECT *, lag(value) OVER (PARTITION BY name, connector, task ORDER BY ts) AS prev FROM s),
i AS (SELECT *, CAST(CASE WHEN value >= prev THEN value - prev ELSE value END AS DECIMAL(18,2)) AS increase FROM d WHERE prev IS NOT NULL)"""


def metric_samples(lake: Lake) -> DataFrame:
    rules = M.rules_for("capture", "capture_metrics")
    return M.extract_metrics(lake.metric_lines(), "line", rules).withColumn("value", F.col("value").cast("decimal(18,2)"))


@query(
    "w02_trailing_rate",
    metric_sql(_RATE + """,
steps_ AS (SELECT connector, ts, sum(increase) AS step FROM i WHERE increase IS NOT NULL GROUP BY 1, 2),
trailing_ AS (SELECT connector, ts, CAST(sum(step) OVER (PARTITION BY connector ORDER BY ts
  RANGE BETWEEN INTERVAL 59999999 MICROSECONDS PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS increase FROM steps_)
SELECT connector, ts, increase, CAST(increase AS DOUBLE) / 60.0 AS per_second FROM trailing_"""),
)
def trailing_rate(lake: Lake) -> DataFrame:
    series = metric_samples(lake).filter(F.col("name").endswith("_total")).select(
        "name", F.col("labels")["connector"].alias("connector"), F.col("labels")["task"].alias("task"), "ts", "value"
    )
    rates = M.trailing_rate(M.counter_increase(series, ["name", "connector", "task"]), ["connector"])
    return rates.select("connector", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("increase").cast("decimal(18,2)").alias("increase"), "per_second")


@query("o01_order_by", order_sql("SELECT id, status FROM mirror ORDER BY id"))
def order_by(lake: Lake) -> DataFrame:
    return A.apply_changes(None, changes(lake), ["id"], POS).select("id", "status").orderBy("id")


@query("o02_order_by_limit", order_sql("SELECT id, amount, status FROM mirror ORDER BY amount DESC, id LIMIT 10"))
def order_by_limit(lake: Lake) -> DataFrame:
    live = A.apply_changes(None, changes(lake), ["id"], POS)
    return live.select("id", "amount", "status").orderBy(F.col("amount").desc(), "id").limit(10)


@query("o03_latest_one", "SELECT event_id, event_type, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_one(lake: Lake) -> DataFrame:
    newest = F.max_by(F.struct("event_id", "event_type", "ts"), F.struct("ts", "event_id")).alias("e")
    return lake.table("events").agg(newest).select("e.*")


@query("o04_sample_rows", order_sql("SELECT id, amount, status FROM mirror ORDER BY id LIMIT 5"))
def sample_rows(lake: Lake) -> DataFrame:
    return A.apply_changes(None, changes(lake), ["id"], POS).select("id", "amount", "status").orderBy("id").limit(5)


@query(
    "u01_union_partitions",
    """
SELECT 'shop.public.orders' AS topic, count(*) AS n, count(DISTINCT o_orderkey) AS keys, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS amount FROM orders""",
)
def union_partitions(lake: Lake) -> DataFrame:
    rows = lake.partition_topics()
    halves = [rows.filter(F.month("created_at") <= 6), rows.filter(F.month("created_at") > 6).withColumn("half", F.lit(2))]
    merged = R.merge_partitions(R.union_all(halves), r"shop\.public\.orders_.*", "shop.public.orders")
    per_key = merged.groupBy("topic", "id").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    return per_key.groupBy("topic").agg(
        F.sum("n").alias("n"), F.count("*").alias("keys"), F.sum("amount").cast("decimal(18,2)").alias("amount")
    )


@query("u02_distinct", order_sql("SELECT DISTINCT status FROM ch WHERE status IS NOT NULL"))
def distinct(lake: Lake) -> DataFrame:
    return changes(lake).select("status").filter("status IS NOT NULL").distinct()


@query(
    "u03_difference",
    order_sql("SELECT o_orderkey AS id FROM orders EXCEPT SELECT id FROM mirror"),
)
def difference(lake: Lake) -> DataFrame:
    return source_rows(lake).select("id").exceptAll(A.apply_changes(None, changes(lake), ["id"], POS).select("id"))


# X: scalar functions -----------------------------------------------------------------------------


@query("x01_concat", "SELECT o_orderpriority || ' / ' || o_custkey || ' / ' || o_orderkey AS label FROM orders")
def concat(lake: Lake) -> DataFrame:
    label = F.concat("o_orderpriority", F.lit(" / "), F.col("o_custkey").cast("string"), F.lit(" / "), F.col("o_orderkey").cast("string"))
    return lake.table("orders").select(label.alias("label"))


@query(
    "x02_format_pad",
    """
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m') AS yyyymm, 'orders_' || strftime(o_orderdate, '%Y_%m') AS part,
  lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS padded FROM orders""",
)
def format_pad(lake: Lake) -> DataFrame:
    return lake.table("orders").select(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyyMM").alias("yyyymm"),
        F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyy_MM")).alias("part"),
        F.lpad(F.col("o_custkey").cast("string"), 8, F.lit("0")).alias("padded"),
    )


@query(
    "x03_dates",
    """
SELECT o_orderkey AS id, make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start,
  CAST(make_date(year(o_orderdate), month(o_orderdate), 1) + INTERVAL 1 MONTH AS DATE) AS month_end, o_orderdate + INTERVAL 10 HOURS AS later FROM orders""",
)
def dates(lake: Lake) -> DataFrame:
    start = F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1))
    return lake.table("orders").select(
        F.col("o_orderkey").alias("id"),
        start.alias("month_start"),
        F.add_months(start, 1).alias("month_end"),
        (F.col("o_orderdate") + F.expr("INTERVAL 10 HOURS")).alias("later"),
    )


@query("x04_least_greatest", "SELECT l_orderkey AS id, least(l_linenumber * 7, 28) AS day, greatest(1, l_linenumber // 3) AS batch, count(*) AS n FROM lineitem GROUP BY 1, 2, 3")
def least_greatest(lake: Lake) -> DataFrame:
    day, batch = F.least(F.col("l_linenumber") * 7, F.lit(28)), F.greatest(F.lit(1), F.floor(F.col("l_linenumber") / 3).cast("int"))
    return lake.table("lineitem").groupBy(F.col("l_orderkey").alias("id"), day.alias("day"), batch.alias("batch")).agg(F.count("*").alias("n"))


@query(
    "x05_arithmetic",
    """
SELECT o_orderkey AS id, o_custkey % 7 + 1 AS bucket, CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands,
  CAST(round(CAST(o_totalprice AS DECIMAL(12,2)), 1) AS DECIMAL(12,1)) AS rounded FROM orders""",
)
def arithmetic(lake: Lake) -> DataFrame:
    return lake.table("orders").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 7 + 1).alias("bucket"),
        F.floor(F.col("o_totalprice") / 1000).alias("thousands"),
        F.round(F.col("o_totalprice").cast("decimal(12,2)"), 1).cast("decimal(12,1)").alias("rounded"),
    )


@query(
    "x06_array_subscript",
    "SELECT o_orderkey AS id, (['URGENT', 'HIGH', 'MEDIUM', 'LOW'])[CAST(left(o_orderpriority, 1) AS INTEGER)] AS word FROM orders",
)
def array_subscript(lake: Lake) -> DataFrame:
    words = ["URGENT", "HIGH", "MEDIUM", "LOW"]  # by the digit a priority begins with; there is no fifth
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), pick(words, F.substring("o_orderpriority", 1, 1).cast("int")).alias("word"))


@query(
    "x07_casts",
    """
SELECT l_orderkey AS id, CAST(CAST(l_linenumber AS DECIMAL(12,2)) * CAST(1.25 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS amount, CAST(l_partkey AS VARCHAR) AS part_text, count(*) AS n
FROM lineitem GROUP BY 1, 2, 3""",
)
def casts(lake: Lake) -> DataFrame:
    amount = (F.col("l_linenumber").cast("decimal(12,2)") * F.lit("1.25").cast("decimal(3,2)")).cast("decimal(12,2)")
    return (
        lake.table("lineitem")
        .groupBy(F.col("l_orderkey").alias("id"), amount.alias("amount"), F.col("l_partkey").cast("string").alias("part_text"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "x08_fixed_number_text",
    "SELECT c_custkey AS id, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance FROM customer",
)
def fixed_number_text(lake: Lake) -> DataFrame:
    return lake.table("customer").select(F.col("c_custkey").alias("id"), money_text(F.col("c_acctbal"), "decimal(12,2)").alias("balance"))


@query(
    "x09_case_in",
    order_sql("SELECT CASE WHEN op IN ('c', 'u', 'r') THEN 'write' ELSE 'remove' END AS act, count(*) AS n FROM ch GROUP BY 1"),
)
def case_in(lake: Lake) -> DataFrame:
    act = F.when(F.col("op").isin(*C.UPSERT_OPS), "write").otherwise("remove")
    return changes(lake).groupBy(act.alias("act")).agg(F.count("*").alias("n"))


@query(
    "x10_json_path",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(value AS DECIMAL(12,2)) AS first_value FROM events",
)
def json_path(lake: Lake) -> DataFrame:
    from tideline.plans.catalog_ingest import wide

    rows = wide(lake, "as_json", "as_string")
    value = F.try_variant_get(F.try_parse_json("as_json"), "$.parts[0].value", "decimal(12,2)")
    return rows.select("event_id", F.try_variant_get(F.try_parse_json("as_string"), "$.k", "bigint").alias("k"), value.alias("first_value"))


@query(
    "x11_regex",
    """
SELECT c_custkey AS id, regexp_matches(c_name, '^Customer#0+[0-9]*5$') AS ends_five, regexp_extract(c_name, '#0*([0-9]+)$', 1) AS digits,
  regexp_replace(c_name, '^Customer#(.*)$', 'C_\\1') AS short FROM customer""",
)
def regex(lake: Lake) -> DataFrame:
    name = F.col("c_name")
    return lake.table("customer").select(
        F.col("c_custkey").alias("id"),
        name.rlike("^Customer#0+[0-9]*5$").alias("ends_five"),
        F.regexp_extract(name, "#0*([0-9]+)$", 1).alias("digits"),
        F.regexp_replace(name, "^Customer#(.*)$", "C_$1").alias("short"),
    )


@query(
    "x12_text",
    "SELECT c_custkey AS id, to_base64(encode(c_mktsegment)) AS encoded, lower(c_mktsegment) AS lowered, trim('  ' || c_name || ' ') AS trimmed FROM customer",
)
def text(lake: Lake) -> DataFrame:
    segment = F.col("c_mktsegment")
    return lake.table("customer").select(
        F.col("c_custkey").alias("id"),
        F.base64(segment.cast("binary")).alias("encoded"),
        F.lower(segment).alias("lowered"),
        F.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("trimmed"),
    )


@query(
    "x13_stable_identifier",
    """
SELECT o_orderkey AS id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS uid
FROM (SELECT o_orderkey, md5(o_orderkey || '|' || o_custkey) AS h FROM orders)""",
)
def stable_identifier(lake: Lake) -> DataFrame:
    return lake.table("orders").select(F.col("o_orderkey").alias("id"), stable_uuid(F.col("o_orderkey"), F.col("o_custkey")).alias("uid"))
