"""Queries for reading, decoding and classifying logs (S, T, F)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions import decode as D
from tideline.functions.names import parse_topic
from tideline.operators import classify as C
from tideline.operators import envelope as E
from tideline.operators import metrics as M
from tideline.operators.apply import apply_changes, parse_signals
from tideline.plans.feeds import CUSTOMERS, ORDERS, ORDERS_SPEC, WIDE_SPEC, Lake, metric_sql, order_sql, pruned, shop_sql, wire_sql
from tideline.plans.registry import query
from tideline.sources import logs
from tideline.spec import Col, TableSpec

# S: sources --------------------------------------------------------------------------------------


@query(
    "s01_read_log",
    shop_sql("""
SELECT topic, CAST(id % 4 AS INTEGER) AS "partition", count(*) AS n, max(seq) AS max_offset FROM (
  SELECT 'shop.public.orders' AS topic, id, seq FROM wire
  UNION ALL SELECT 'shop.public.customers', id, seq FROM cch
  UNION ALL SELECT 'shop.purchasing.suppliers', supplier_id, seq FROM sch) GROUP BY 1, 2"""),
)
def read_log(lake: Lake) -> DataFrame:
    log = logs.read_log(lake.spark, lake.raw_files())
    return log.groupBy("topic", "partition").agg(F.count("*").alias("n"), F.max("offset").alias("max_offset"))


@query(
    "s02_include_tables",
    shop_sql("""
SELECT 'public' AS schema_name, 'customers' AS table_name, count(*) AS n FROM cch
UNION ALL SELECT 'purchasing', 'suppliers', count(*) FROM sch"""),
)
def include_tables(lake: Lake) -> DataFrame:
    where = parse_topic(F.col("topic"))
    named = lake.raw().select(where["schema"].alias("schema_name"), where["table"].alias("table_name"))
    kept = C.include_tables(named, ["public.customers"], [r"purchasing\.sup[a-z]+"])
    return kept.groupBy("schema_name", "table_name").agg(F.count("*").alias("n"))


@query(
    "s03_subscribe",
    shop_sql("""
SELECT 'shop.public.orders' AS topic, count(*) AS n FROM wire
UNION ALL SELECT 'shop.public.customers', count(*) FROM cch"""),
)
def subscribe(lake: Lake) -> DataFrame:
    kept = logs.subscribe(lake.raw(), regex=r"shop\.public\.(orders|customers)")
    return kept.groupBy("topic").agg(F.count("*").alias("n"))


@query(
    "s04_unwrap_payload",
    wire_sql("""
SELECT id % 4 < 2 AS wrapped, coalesce(op, '') AS op, count(*) AS n FROM wire
WHERE kind NOT IN (4, 6) GROUP BY 1, 2"""),
)
def unwrap(lake: Lake) -> DataFrame:
    body = E.unwrap_payload(F.col("value"))
    rows = lake.order_raw().select((F.col("partition") < 2).alias("wrapped"), body.alias("event")).filter("event IS NOT NULL")
    op = F.coalesce(F.try_variant_get("event", "$.op", "string"), F.lit(""))
    return rows.groupBy("wrapped", op.alias("op")).agg(F.count("*").alias("n"))


@query(
    "s05_parse_envelope",
    wire_sql("""
SELECT seq AS "offset", op, ts_ms, 'public' AS schema_name, 'orders' AS table_name FROM wire WHERE op IS NOT NULL"""),
)
def envelope(lake: Lake) -> DataFrame:
    return E.parse_envelope(lake.order_raw()).filter(C.has_op()).select("offset", "op", "ts_ms", "schema_name", "table_name")


@query(
    "s06_parse_key",
    wire_sql("""
SELECT w.seq AS "offset", CASE WHEN kind IN (7, 9) OR (kind = 1 AND s0 = 'P') OR (kind = 3 AND priority = '5-LOW')
  THEN NULL ELSE w.id END AS id FROM wire w JOIN steps USING (id)"""),
)
def key(lake: Lake) -> DataFrame:
    return E.parse_key(lake.order_raw(), ORDERS_SPEC).select("offset", "key_fields.id")


@query(
    "s06_parse_composite_key",
    "SELECT l_orderkey AS order_id, l_linenumber AS line, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def composite_key(lake: Lake) -> DataFrame:
    spec = TableSpec("lines", ("order_id", "line"), (Col("order_id", "bigint", "int"), Col("line", "int", "int")))
    raw = lake.line_changes().select(F.to_json(F.struct("order_id", "line")).alias("key"))
    return E.parse_key(raw, spec).groupBy("key_fields.order_id", "key_fields.line").agg(F.count("*").alias("n"))


@query(
    "s07_snapshot",
    "SELECT c_custkey AS id, c_name AS name, CAST(c_acctbal AS DECIMAL(12,2)) AS balance, 'r' AS op FROM customer",
)
def snapshot(lake: Lake) -> DataFrame:
    rows = lake.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").cast("decimal(12,2)").alias("balance")
    )
    return logs.snapshot(rows)


@query(
    "s08_partitioned_snapshot",
    """
SELECT 'r' AS op, strftime(o_orderdate, '%Y_%m') AS month, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS amount FROM orders GROUP BY 2""",
)
def partitioned_snapshot(lake: Lake) -> DataFrame:
    path = lake.scratch("months")
    months = lake.partition_topics().withColumn("month", F.date_format("created_at", "yyyy_MM"))
    months.hint("rebalance", F.col("month")).write.partitionBy("month").parquet(path)
    rows = logs.snapshot(logs.read_table(lake.spark, path))
    return rows.groupBy("op", "month").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount"))


@query(
    "s09_start_earliest",
    shop_sql("""
SELECT topic, min(seq) AS first_offset, count(*) AS n FROM (
  SELECT 'shop.public.orders' AS topic, seq FROM wire
  UNION ALL SELECT 'shop.public.customers', seq FROM cch) GROUP BY 1"""),
)
def earliest(lake: Lake) -> DataFrame:
    log = logs.read_log(lake.spark, lake.raw_files(), topics=[ORDERS, CUSTOMERS], starting="earliest")
    return log.groupBy("topic").agg(F.min("offset").alias("first_offset"), F.count("*").alias("n"))


@query(
    "s10_parse_signals",
    """
SELECT 'supplier-' || s_suppkey AS id, 'shopdb' AS "database", x.schema_name, x.table_name || s_nationkey AS table_name
FROM supplier, (VALUES ('public', 'orders_'), ('purchasing', 'supplies_')) x(schema_name, table_name) WHERE s_acctbal >= 0""",
)
def signals(lake: Lake) -> DataFrame:
    nation = F.col("s_nationkey").cast("string")
    data = F.to_json(
        F.struct(F.array(F.concat(F.lit("shopdb.public.orders_"), nation), F.concat(F.lit("shopdb.purchasing.supplies_"), nation)).alias("data-collections"))
    )
    rows = lake.table("supplier").select(
        F.concat(F.lit("supplier-"), F.col("s_suppkey").cast("string")).alias("id"),
        F.when(F.col("s_acctbal") >= 0, "execute-snapshot").otherwise("log").alias("type"),
        data.alias("data"),
    )
    return parse_signals(rows)


@query("s11_extract_metrics", metric_sql("SELECT event_id, name, connector, task, version, type, status, class, value FROM metric"))
def metric_rows(lake: Lake) -> DataFrame:
    samples = M.extract_metrics(lake.metric_lines(), "line", M.rules_for("capture", "capture_metrics"))
    labels = ("connector", "task", "version", "type", "status", "class")
    return samples.select("event_id", "name", *[F.col("labels")[x].alias(x) for x in labels], "value")


@query(
    "s12_series_per_row",
    """
SELECT i, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
FROM (SELECT l_orderkey, unnest(generate_series(1, l_linenumber)) AS i FROM lineitem) GROUP BY i""",
)
def series(lake: Lake) -> DataFrame:
    rows = logs.series_per_row(lake.table("lineitem").select("l_orderkey", "l_linenumber"), F.lit(1).cast("bigint"), F.col("l_linenumber").cast("bigint"))
    return rows.groupBy("i").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("key_sum"))


@query(
    "s13_grid",
    """
SELECT p_partkey, layer, box, p_partkey || '/' || layer || '/' || box AS label
FROM (SELECT p_partkey, unnest(generate_series(1, p_size % 4 + 1)) AS layer FROM part), (SELECT unnest(generate_series(1, 2)) AS box)""",
)
def grid(lake: Lake) -> DataFrame:
    """The boxes of every part: as many layers as its size asks for, two boxes on each."""
    axes = {"layer": (F.lit(1).cast("bigint"), (F.col("p_size") % 4 + 1).cast("bigint")), "box": (F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))}
    rows = logs.grid(lake.table("part").select("p_partkey", "p_size"), axes)
    return rows.select("p_partkey", "layer", "box", F.concat_ws("/", "p_partkey", "layer", "box").alias("label"))


@query(
    "s14_literal_rows",
    """
SELECT t.desk, count(*) AS n FROM customer c
JOIN (VALUES ('AUTOMOBILE', 1), ('BUILDING', 2), ('MACHINERY', 2)) t(segment, desk)
ON c.c_mktsegment = t.segment GROUP BY 1""",
)
def literal_rows(lake: Lake) -> DataFrame:
    desks = logs.literal(lake.spark, [("AUTOMOBILE", 1), ("BUILDING", 2), ("MACHINERY", 2)], "c_mktsegment string, desk int")
    return lake.table("customer").join(desks, "c_mktsegment").groupBy("desk").agg(F.count("*").alias("n"))


@query("s15_read_target", order_sql("SELECT id, customer_id, amount, status FROM mirror"))
def read_target(lake: Lake) -> DataFrame:
    path = lake.scratch("target")
    mirror = apply_changes(None, lake.order_changes().drop("topic", "partition", "ts_ms"), ["id"], ["offset"])
    mirror.write.parquet(path)
    return logs.read_table(lake.spark, path).select("id", "customer_id", "amount", "status")


# T: decoders -------------------------------------------------------------------------------------


def wide(lake: Lake, *names: str) -> DataFrame:
    spec = pruned(WIDE_SPEC, *names)
    return E.decode(E.parse_envelope(lake.wide_raw()), spec).select("id.event_id", *[F.col("after")[n].alias(n) for n in names])


@query(
    "t01_decimal_text",
    """
SELECT event_id, CAST(value AS DECIMAL(12,2)) AS as_decimal,
  CAST(event_id || '.' || lpad(CAST(user_id AS VARCHAR), 18, '0') AS DECIMAL(28,18)) AS as_fine_decimal FROM events""",
)
def t_decimal(lake: Lake) -> DataFrame:
    return wide(lake, "as_decimal", "as_fine_decimal")


@query("t02_decimal_bytes", "SELECT event_id, CAST(CAST(value AS DECIMAL(12,2)) - 50 AS DECIMAL(12,2)) AS as_connect_decimal FROM events")
def t_decimal_bytes(lake: Lake) -> DataFrame:
    return wide(lake, "as_connect_decimal")


@query(
    "t03_nested_json",
    """
SELECT event_id, event_type AS name, CAST(json_extract_string(props, '$.k') AS INTEGER) AS count, CAST(value AS DECIMAL(12,2)) AS value FROM events
UNION ALL SELECT event_id, 'user', CAST(user_id AS INTEGER), CAST(0 AS DECIMAL(12,2)) FROM events""",
)
def t_nested(lake: Lake) -> DataFrame:
    shape = "parts array<struct<name:string,count:int,value:decimal(12,2)>>"
    return wide(lake, "as_json").select("event_id", F.inline(F.from_json("as_json", shape)["parts"]))


@query("t04_bytes", "SELECT event_id, hex(encode(event_type)) AS as_bytes FROM events")
def t_bytes(lake: Lake) -> DataFrame:
    return wide(lake, "as_bytes").select("event_id", F.hex("as_bytes").alias("as_bytes"))


@query(
    "t05_array",
    "SELECT event_id, unnest([event_type, 'user' || user_id]) AS part, event_type = 'error' AS has_error FROM events",
)
def t_array(lake: Lake) -> DataFrame:
    return wide(lake, "as_array").select("event_id", F.explode("as_array").alias("part"), F.array_contains("as_array", "error").alias("has_error"))


@query("t06_micro_timestamp", "SELECT event_id, ts AS as_micro_timestamp FROM events")
def t_micro_timestamp(lake: Lake) -> DataFrame:
    return wide(lake, "as_micro_timestamp")


@query("t07_zoned_timestamp", "SELECT event_id, epoch_us(ts) AS us FROM events")
def t_zoned_timestamp(lake: Lake) -> DataFrame:
    return wide(lake, "as_zoned_timestamp").select("event_id", F.unix_micros("as_zoned_timestamp").alias("us"))


@query(
    "t08_times",
    """
SELECT event_id, epoch_us(ts) % 86400000000 AS as_micro_time, strftime(ts, '%H:%M:%S.%f') AS shown,
  strftime(ts, '%H:%M:%S.%f') || 'Z' AS as_zoned_time FROM events""",
)
def t_times(lake: Lake) -> DataFrame:
    rows = wide(lake, "as_micro_time", "as_zoned_time")
    return rows.withColumn("shown", D.format_micros_of_day(F.col("as_micro_time")))


@query("t09_date", "SELECT event_id, CAST(ts AS DATE) AS as_date FROM events")
def t_date(lake: Lake) -> DataFrame:
    return wide(lake, "as_date")


@query(
    "t10_uuid_bool_int",
    """
SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS uuid,
  user_id AS as_int, value > 50 AS as_bool FROM (SELECT *, md5(CAST(event_id AS VARCHAR)) AS h FROM events)""",
)
def t_scalars(lake: Lake) -> DataFrame:
    return wide(lake, "uuid", "as_int", "as_bool")


@query(
    "t11_defaults",
    """
SELECT event_id, CASE event_type WHEN 'view' THEN 'web' WHEN 'click' THEN NULL ELSE 'app' END AS channel FROM events""",
)
def t_defaults(lake: Lake) -> DataFrame:
    spec = pruned(WIDE_SPEC, "channel")
    rows = E.apply_defaults(E.decode(E.parse_envelope(lake.wide_raw()), spec), spec)
    return rows.select("id.event_id", "after.channel")


# F: filters --------------------------------------------------------------------------------------


@query("f01_drop_tombstones", wire_sql('SELECT seq AS "offset", CAST(id % 4 AS INTEGER) AS "partition" FROM wire WHERE kind <> 4'))
def f_tombstones(lake: Lake) -> DataFrame:
    return C.drop_tombstones(lake.order_raw()).select("offset", "partition")


@query("f02_data_only", wire_sql('SELECT seq AS "offset", op FROM wire WHERE op IS NOT NULL'))
def f_data(lake: Lake) -> DataFrame:
    return E.parse_envelope(lake.order_raw()).filter(C.has_op()).select("offset", "op")


@query(
    "f02_control_rows",
    wire_sql('SELECT seq AS "offset", ts_ms AS resolved FROM wire WHERE kind = 9'),
)
def f_control(lake: Lake) -> DataFrame:
    _, control, _ = C.classify(lake.order_raw(), ORDERS_SPEC)
    return control.select("offset", F.substring_index(F.try_variant_get("event", "$.resolved", "string"), ".", 1).try_cast("bigint").alias("resolved"))


@query(
    "f03_classify",
    wire_sql("""
SELECT CASE WHEN kind = 4 THEN 'tombstone' WHEN kind = 9 THEN 'control' WHEN kind = 3 THEN 'delete' WHEN kind = 11 THEN 'skip'
  WHEN kind IN (6, 7, 8, 10, 12) THEN 'quarantine' ELSE 'upsert' END AS disposition, count(*) AS n FROM wire GROUP BY 1"""),
)
def f_classify(lake: Lake) -> DataFrame:
    return C.with_disposition(lake.order_raw(), ORDERS_SPEC).groupBy("disposition").agg(F.count("*").alias("n"))


@query("f04_no_key", wire_sql("SELECT seq AS \"offset\", 'no_key' AS reason FROM wire WHERE kind = 7"))
def f_no_key(lake: Lake) -> DataFrame:
    _, _, bad = C.classify(lake.order_raw(), ORDERS_SPEC)
    return bad.filter("reason = 'no_key'").select("offset", "reason")


@query(
    "f05_quarantine",
    wire_sql("""
SELECT seq AS "offset", CASE kind WHEN 6 THEN 'unparsable' WHEN 7 THEN 'no_key' WHEN 8 THEN 'unknown_op' ELSE 'bad_value:amount' END AS reason
FROM wire WHERE kind IN (6, 7, 8, 10, 12)"""),
)
def f_quarantine(lake: Lake) -> DataFrame:
    _, _, bad = C.classify(lake.order_raw(), ORDERS_SPEC)
    return bad.select("offset", "reason")


@query(
    "f06_exclude_control_tables",
    shop_sql("""
SELECT 'public' AS schema_name, 'orders' AS table_name, count(*) AS n FROM wire
UNION ALL SELECT 'public', 'customers', count(*) FROM cch"""),
)
def f_exclude(lake: Lake) -> DataFrame:
    where = parse_topic(F.col("topic"))
    named = lake.raw().select(where["schema"].alias("schema_name"), where["table"].alias("table_name"))
    return C.exclude_tables(named, ["purchasing.suppliers"]).groupBy("schema_name", "table_name").agg(F.count("*").alias("n"))


@query("f07_equality", "SELECT o_orderkey AS id, o_orderpriority AS priority FROM orders WHERE o_orderpriority = '1-URGENT'")
def f_equality(lake: Lake) -> DataFrame:
    hit = C.where_equals(lake.table("orders"), "o_orderpriority", "1-URGENT")
    return hit.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"))


@query(
    "f08_like",
    """
SELECT count(*) FILTER (WHERE c_name LIKE 'Customer#0000001%') AS prefixed, count(*) FILTER (WHERE c_name LIKE '%99%') AS inside,
  count(*) FILTER (WHERE c_mktsegment ILIKE 'build%') AS any_case, count(*) FILTER (WHERE c_mktsegment NOT ILIKE '%in%') AS negated
FROM customer""",
)
def f_like(lake: Lake) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return lake.table("customer").agg(
        F.count_if(C.like(name, "Customer#0000001%")).alias("prefixed"),
        F.count_if(C.like(name, "%99%")).alias("inside"),
        F.count_if(C.like(segment, "build%", ignore_case=True)).alias("any_case"),
        F.count_if(C.like(segment, "%in%", ignore_case=True, negate=True)).alias("negated"),
    )


@query("f09_op_filter", wire_sql("SELECT w.seq AS \"offset\", w.op, s.a0 AS amount, s.s0 AS status FROM wire w JOIN steps s USING (id) WHERE w.op = 'r'"))
def f_op(lake: Lake) -> DataFrame:
    data, _, _ = C.classify(lake.order_raw(), ORDERS_SPEC)
    return C.only_ops(data, ["r"]).select("offset", "op", "after.amount", "after.status")


@query("f10_has_field", "SELECT event_id, CASE WHEN event_type <> 'click' THEN 'app' END AS channel FROM events WHERE event_type <> 'view'")
def f_has_field(lake: Lake) -> DataFrame:
    rows = E.decode(E.parse_envelope(lake.wide_raw()), pruned(WIDE_SPEC, "channel"))
    return rows.filter(C.has_field("channel")).select("id.event_id", "after.channel")


@query(
    "f11_severe_lines",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ERROR task user' || user_id || ' ' ||
  CASE WHEN json_extract_string(props, '$.k')::INT < 50 THEN 'a retry follows' ELSE 'write failed' END AS line
FROM events WHERE event_type = 'error' AND json_extract_string(props, '$.k')::INT >= 50 ORDER BY ts DESC, event_id DESC LIMIT 5""",
)
def f_severe(lake: Lake) -> DataFrame:
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    text = F.when(F.get_json_object("props", "$.k").cast("int") < 50, "a retry follows").otherwise("write failed")
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" "), level, F.lit(" task user"), F.col("user_id").cast("string"), F.lit(" "), text
    )
    rows = lake.table("events").select("event_id", "ts", line.alias("line"))
    found = C.severe_lines(rows, "line", r" ERROR ", r"retry follows|ignored", ["ts", "event_id"], 5)
    return found.select("event_id", "line")
