"""Queries for projecting, renaming and routing changes (D) and for declared flows (E)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.names import parse_topic, quote, table_name
from tideline.operators import classify as C
from tideline.operators import envelope as E
from tideline.operators import route as R
from tideline.operators import verify as V
from tideline.operators.apply import apply_changes
from tideline.plans import flow
from tideline.plans.feeds import (
    CUSTOMERS,
    CUSTOMERS_SPEC,
    ORDERS,
    ORDERS_SPEC,
    SUPPLIERS,
    SUPPLIERS_SPEC,
    Lake,
    customer_sql,
    order_sql,
    pruned,
    shop_sql,
    wire_sql,
)
from tideline.plans.registry import query
from tideline.spec import FlowSpec, Step


def data(lake: Lake, before: bool = False) -> DataFrame:
    return C.classify(lake.order_raw(), ORDERS_SPEC, before)[0]


_FLAT = """
SELECT id, customer_id, amount, status, op AS __op, ts_ms AS __ts_ms, 'false' AS __deleted, seq AS "offset" FROM ch WHERE op <> 'd'"""


@query(
    "d01_flatten",
    order_sql(_FLAT),
)
def flatten(lake: Lake) -> DataFrame:
    return R.flatten(data(lake), ORDERS_SPEC, deletes="drop").drop("topic", "partition")


@query(
    "d02_delete_rewrite",
    order_sql(f"""{_FLAT} UNION ALL
SELECT id, CASE WHEN moved THEN c0 + 1 ELSE c0 END, a1, s1, 'd', base_ms + 259200000, 'true', id * 20 + 3 FROM steps WHERE removed"""),
)
def delete_rewrite(lake: Lake) -> DataFrame:
    return R.flatten(data(lake, before=True), ORDERS_SPEC).drop("topic", "partition")


@query(
    "d03_rename_topics",
    shop_sql("""
SELECT 'public_orders' AS topic, count(*) AS n FROM wire UNION ALL SELECT 'public_customers', count(*) FROM cch
UNION ALL SELECT 'shop.purchasing.suppliers', count(*) FROM sch"""),
)
def rename_topics(lake: Lake) -> DataFrame:
    return R.rename_topics(lake.raw(), r"shop\.public\.(.*)", "public_$1").groupBy("topic").agg(F.count("*").alias("n"))


@query(
    "d04_merge_partitions",
    """
SELECT 'shop.public.orders' AS topic, o_orderkey AS id, 'shop.public.orders_' || strftime(o_orderdate, '%Y_%m') AS part,
  CAST(o_totalprice AS DECIMAL(12,2)) AS amount FROM orders""",
)
def merge_partitions(lake: Lake) -> DataFrame:
    merged = R.merge_partitions(lake.partition_topics(), r"shop\.public\.orders_.*", ORDERS, key_field="part")
    return merged.select("topic", "id", "part", "amount")


_MOVES = """
p AS (SELECT o_orderkey AS id, date_trunc('month', o_orderdate) AS m0, o_orderstatus AS s0, o_custkey % 3 AS turn,
  CAST(o_totalprice AS DECIMAL(12,2)) AS a0, CAST(o_totalprice AS DECIMAL(12,2)) > 150000 AS moved, o_orderpriority = '5-LOW' AS dropped FROM orders)"""


@query(
    "d04_merge_and_apply",
    f"""WITH {_MOVES.strip()}
SELECT id, CASE WHEN moved THEN CAST(a0 + 1 AS DECIMAL(12,2)) ELSE a0 END AS amount, CASE WHEN moved THEN 'moved' ELSE s0 END AS status
FROM p WHERE NOT dropped""",
)
def merge_and_apply(lake: Lake) -> DataFrame:
    """Orders that move to the topic of another month within one millisecond: removed there, created here. Only the hybrid time tells
    which came last, since offsets of two topics cannot be compared and half of the moves go to an earlier month."""
    declared = FlowSpec(
        transforms=[Step("merge", R.merge_partitions, {"pattern": r"shop\.public\.orders_.*", "target": ORDERS})],
        tables={"orders": pruned(ORDERS_SPEC, "amount", "status")},
        table_template="${source.table}",
    )
    return flow.run_batch(lake.partition_raw(), declared)["orders"]


@query("d05_stamp_topic", customer_sql("SELECT seq AS \"offset\", 'shop.public.customers' AS _topic FROM cch"))
def stamp_topic(lake: Lake) -> DataFrame:
    return R.stamp_topic(lake.customer_raw()).select("offset", "_topic")


_ROUTES = {"lake.orders": r"shop\.public\.orders", "lake.customers": r"shop\.public\.customers", "lake.everything": r"shop\..*"}


@query(
    "d06_route_by_field",
    shop_sql("""
SELECT 'lake.orders' AS route, count(*) AS n FROM wire UNION ALL SELECT 'lake.customers', count(*) FROM cch
UNION ALL SELECT 'lake.everything', (SELECT count(*) FROM wire) + (SELECT count(*) FROM cch) + (SELECT count(*) FROM sch)"""),
)
def route_by_field(lake: Lake) -> DataFrame:
    rows = R.stamp_topic(lake.raw())
    return R.route_tags(rows, "_topic", _ROUTES).groupBy("route").agg(F.count("*").alias("n"))


@query(
    "d07_table_name",
    shop_sql("""
SELECT by_topic, by_source, by_source AS after_rename, 'ORDERS_COPY' AS fixed, CAST(sum(n) AS BIGINT) AS n FROM (
SELECT 'shop_public_orders' AS by_topic, 'public_orders' AS by_source, count(*) AS n FROM wire
UNION ALL SELECT 'shop_public_customers', 'public_customers', count(*) FROM cch
UNION ALL SELECT 'shop_purchasing_suppliers', 'purchasing_suppliers', count(*) FROM sch) GROUP BY 1, 2"""),
)
def names_from_template(lake: Lake) -> DataFrame:
    """Names by topic and by source; the source's hold after a topic is renamed, from the event itself or from the topic it came by."""
    topic, by_source = F.col("topic"), "${source.schema}_${source.table}"
    renamed = R.rename_topics(lake.raw().withColumn("origin", topic), r"shop\.[a-z]+\.(.*)", "$1", column="topic")
    named = renamed.select(
        table_name(F.col("origin"), "${topic}").alias("by_topic"),
        table_name(F.col("origin"), by_source, F.col("value")).alias("by_source"),
        table_name(topic, by_source, F.col("value"), F.col("origin")).alias("after_rename"),
        table_name(topic, "ORDERS_COPY").alias("fixed"),
    )
    return named.groupBy("by_topic", "by_source", "after_rename", "fixed").agg(F.count("*").alias("n"))


@query(
    "d08_parse_topic",
    """
SELECT 'shop' AS prefix3, 'public' AS schema3, 'orders_' || strftime(o_orderdate, '%Y_%m') AS table3,
  'raw.feed.' AS prefix4, 'shopdb' AS database4, 'public' AS schema4, 'orders_' || strftime(o_orderdate, '%Y_%m') AS table4, count(*) AS n
FROM orders GROUP BY 3, 7""",
)
def topics(lake: Lake) -> DataFrame:
    rows = lake.partition_topics().withColumn("feed", F.concat(F.lit("raw.feed.shopdb."), F.substring("topic", 6, 100)))
    three, four = parse_topic(F.col("topic")), parse_topic(F.col("feed"), parts=4, prefix="raw.feed.")
    return rows.groupBy(
        three["prefix"].alias("prefix3"),
        three["schema"].alias("schema3"),
        three["table"].alias("table3"),
        four["prefix"].alias("prefix4"),
        four["database"].alias("database4"),
        four["schema"].alias("schema4"),
        four["table"].alias("table4"),
    ).agg(F.count("*").alias("n"))


@query("d09_resolve_key", wire_sql('SELECT seq AS "offset", CASE WHEN kind <> 7 THEN id END AS id FROM wire WHERE op IS NOT NULL'))
def key_fallback(lake: Lake) -> DataFrame:
    rows = E.parse_envelope(lake.order_raw()).filter(C.has_op())
    return E.resolve_key(rows, ORDERS_SPEC).select("offset", "id.id")


@query(
    "d10_select_key_fields",
    "SELECT l_orderkey AS order_id, l_linenumber AS line, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def selected_keys(lake: Lake) -> DataFrame:
    from tideline.spec import Col, TableSpec

    lines = TableSpec("lines", ("order_id", "line"), (Col("order_id", "bigint"), Col("line", "int")))
    keys = R.key_columns(lines, ["order_id", "line", "created_at"])
    return lake.line_changes().groupBy(*keys).agg(F.count("*").alias("n"))


@query("d11_quoted_names", 'SELECT o_orderkey AS "rowid", o_orderstatus AS "order", o_custkey AS "Group.By" FROM orders')
def quoted(lake: Lake) -> DataFrame:
    odd = lake.table("orders").toDF("rowid", "Group.By", "order", "`Total`", "select", "from")
    return odd.select(quote("rowid"), quote("order"), F.col(quote("Group.By")))


@query(
    "d12_before_after",
    order_sql("""
SELECT * FROM (
  SELECT id * 20 + 1 AS "offset", c0 AS old_customer, c0 AS new_customer, a0 AS old_amount, a1 AS new_amount, s0 AS old_status, s1 AS new_status FROM steps WHERE shipped
  UNION ALL SELECT id * 20 + 1, c0, c0, a0, a1, s0, s1 FROM steps WHERE redelivered
  UNION ALL SELECT id * 20 + 2, c0, c0 + 1, a1, a1, s1, s1 FROM steps WHERE moved)"""),
)
def before_after(lake: Lake) -> DataFrame:
    pairs = R.images(data(lake, before=True))
    fields = {"customer": "customer_id", "amount": "amount", "status": "status"}
    return pairs.select(
        "offset",
        *[F.col(f"before.{c}").alias(f"old_{n}") for n, c in fields.items()],
        *[F.col(f"after.{c}").alias(f"new_{n}") for n, c in fields.items()],
    )


@query(
    "d13_fan_out",
    order_sql("""
SELECT 'history' AS sink, count(*) AS n FROM ch
UNION ALL SELECT 'mirror', count(*) FROM mirror"""),
)
def two_sinks(lake: Lake) -> DataFrame:
    root = lake.scratch("fan")
    changes = flow.flat_changes(lake.order_raw(), ORDERS_SPEC)

    def history(df: DataFrame) -> None:
        df.write.parquet(f"{root}/history")

    def mirror(df: DataFrame) -> None:
        apply_changes(None, df, ["id"], ["partition", "offset"]).write.parquet(f"{root}/mirror")

    R.fan_out(changes, [history, mirror])
    return V.table_counts({n: lake.spark.read.parquet(f"{root}/{n}") for n in ("history", "mirror")}).withColumnRenamed("table_name", "sink")


def routed_mirrors(lake: Lake) -> dict[str, DataFrame]:
    specs = {"public_orders": ORDERS_SPEC, "public_customers": CUSTOMERS_SPEC}
    named = R.fan_in_rows(lake.raw(), r"shop\.public\.(.*)", "public_$1")
    return flow.apply_tables_once(named, specs, ["partition", "offset"])


@query(
    "d14_fan_in",
    shop_sql("""
SELECT 'public_orders' AS table_name, count(*) AS n FROM mirror UNION ALL SELECT 'public_customers', count(*) FROM cmirror"""),
)
def fan_in(lake: Lake) -> DataFrame:
    return V.table_counts(routed_mirrors(lake))


@query(
    "d15_display",
    shop_sql("""
SELECT op, name, CAST(sum(n) AS BIGINT) AS n FROM (
SELECT op, CASE WHEN op = 'd' OR kind = 11 THEN '' ELSE CASE WHEN kind = 0 OR kind = 7 OR kind = 8 THEN s0
  WHEN kind = 5 THEN 'reopened' WHEN kind IN (1, 2) THEN s1 ELSE s0 END END AS name, count(*) AS n
FROM wire JOIN steps USING (id) WHERE op IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT op, coalesce(name, ''), count(*) FROM cch GROUP BY 1, 2) GROUP BY 1, 2"""),
)
def display(lake: Lake) -> DataFrame:
    rows = E.parse_envelope(lake.order_raw().unionByName(lake.customer_raw())).filter(C.has_op())
    return R.display(rows, ["status", "name"]).groupBy("op", "name").agg(F.count("*").alias("n"))


@query(
    "d16_rename_columns",
    'SELECT c_name AS "Customer", c_mktsegment AS "Segment", c_custkey AS "Number" FROM customer',
)
def renamed_view(lake: Lake) -> DataFrame:
    titles = {"c_name": "Customer", "c_mktsegment": "Segment", "c_custkey": "Number"}
    return R.rename_columns(lake.table("customer"), titles, ["c_name", "c_mktsegment", "c_custkey"])


# E: user extension -------------------------------------------------------------------------------


@query(
    "e01_batch_hook",
    shop_sql("""
SELECT 'shop_public_orders' AS target, count(*) AS n FROM wire UNION ALL SELECT 'shop_public_customers', count(*) FROM cch"""),
)
def batch_hook(lake: Lake) -> DataFrame:
    from tideline.sources.logs import read_log
    from tideline.streaming.run import per_batch_folder, read_batches

    seen = lake.scratch("hook")
    keep = per_batch_folder(seen)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        keep(batch.groupBy("target").agg(F.count("*").alias("n")), batch_id)

    declared = FlowSpec(topics=(ORDERS, CUSTOMERS), on_batch=on_batch)
    stream = read_log(lake.spark, lake.raw_files(), streaming=True, max_files_per_trigger=2)
    running, _ = flow.run_stream(stream, declared, lake.scratch("flow"))
    running.awaitTermination()
    return read_batches(lake.spark, seen).groupBy("target").agg(F.sum("n").alias("n"))


@query(
    "e02_transform_chain",
    shop_sql("""
SELECT 'public_orders' AS topic, 'shop.public.orders' AS _topic, count(*) AS n FROM wire
UNION ALL SELECT 'public_customers', 'shop.public.customers', count(*) FROM cch
UNION ALL SELECT 'shop.purchasing.suppliers', 'shop.purchasing.suppliers', count(*) FROM sch"""),
)
def transform_chain(lake: Lake) -> DataFrame:
    config = {
        "transforms": ["stamp", "shorten"],
        "stamp.type": "stamp_topic",
        "stamp.field": "_topic",
        "shorten.type": "rename",
        "shorten.pattern": r"shop\.public\.(.*)",
        "shorten.replacement": "public_$1",
    }
    rows = flow.chain(lake.raw(), flow.from_config(config, {}).transforms)
    return rows.groupBy("topic", "_topic").agg(F.count("*").alias("n"))


@query("e03_gated_transform", wire_sql('SELECT kind = 4 AS is_tombstone, count(*) AS n FROM wire WHERE kind <> 4 GROUP BY 1'))
def gated(lake: Lake) -> DataFrame:
    drop = Step("dropTombstones", lambda df: df.filter(F.lit(False)), predicate=C.is_tombstone())
    rows = flow.chain(lake.order_raw(), [drop])
    return rows.groupBy(F.col("value").isNull().alias("is_tombstone")).agg(F.count("*").alias("n"))


@query(
    "e04_table_templates",
    shop_sql("""
SELECT 'orders' AS table_name, count(*) AS n FROM mirror UNION ALL SELECT 'suppliers', count(*) FROM smirror"""),
)
def templates(lake: Lake) -> DataFrame:
    declared = FlowSpec(
        topics=(ORDERS, SUPPLIERS), tables={"orders": ORDERS_SPEC, "suppliers": SUPPLIERS_SPEC}, table_template="${source.table}"
    )
    return V.table_counts(flow.run_batch(lake.raw(), declared))


@query(
    "e05_declared_flow",
    shop_sql("SELECT id, name, segment, balance FROM cmirror"),
)
def declared_flow(lake: Lake) -> DataFrame:
    config = {
        "topics.regex": r"shop\.public\.(orders|customers)",
        "transforms": ["clean", "route"],
        "clean.type": "drop_tombstones",
        "route.type": "rename",
        "route.pattern": r"shop\.public\.(.*)",
        "route.replacement": "public_$1",
        "route.predicate": "isPublic",
        "predicates": {"isPublic": "topic LIKE 'shop.public.%'"},
    }
    return flow.run_batch(lake.raw(), flow.from_config(config, {"public_customers": CUSTOMERS_SPEC}))["public_customers"]
