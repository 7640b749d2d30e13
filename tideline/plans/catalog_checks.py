"""Queries that verify targets (V) and audit declared constraints (Q)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators import apply as A
from tideline.operators import audit as Q
from tideline.operators import verify as V
from tideline.plans.catalog_route import routed_mirrors
from tideline.plans.catalog_state import changes, order_history, source_rows
from tideline.plans.feeds import Lake, order_sql, shop_sql, wire_sql
from tideline.plans.registry import query
from tideline.sources import logs
from tideline.spec import Col, ForeignKey, TableSpec


def mirror(lake: Lake) -> DataFrame:
    return A.apply_changes(None, changes(lake), ["id"], ["offset"])


def mirror_by_time(lake: Lake) -> DataFrame:
    """The mirror worked out a second way: deduplicated first, ordered by event time and offset."""
    log = A.dedup(lake.order_changes()).select("id", "op", "customer_id", "amount", "status", "ts_ms", "offset")
    return A.apply_changes(None, log, ["id"], ["ts_ms", "offset"])


# V: verification ---------------------------------------------------------------------------------


@query(
    "v01_counts",
    order_sql("""
SELECT 'orders' AS table_name, CAST((SELECT count(*) FROM orders) AS VARCHAR) AS source, CAST((SELECT count(*) FROM mirror) AS VARCHAR) AS target,
  (SELECT count(*) FROM orders) = (SELECT count(*) FROM mirror) AS equal"""),
)
def counts(lake: Lake) -> DataFrame:
    return V.parity({"orders": source_rows(lake)}, {"orders": mirror(lake)})


@query("v02_sum", order_sql("SELECT CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM mirror"))
def total(lake: Lake) -> DataFrame:
    return mirror(lake).agg(F.sum("amount").cast("decimal(18,2)").alias("amount"))


@query(
    "v03_fingerprint",
    order_sql("SELECT count(*) || '|' || CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS VARCHAR) AS fingerprint FROM ch WHERE op <> 'd'"),
)
def fingerprint(lake: Lake) -> DataFrame:
    return V.fingerprint(changes(lake).filter("op <> 'd'"), "amount")


_NINE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations"]


@query(
    "v04_nine_tables",
    "SELECT " + " || '|' || ".join(f"(SELECT count(*) FROM {t})" for t in _NINE) + " AS fingerprint",
)
def nine_tables(lake: Lake) -> DataFrame:
    return V.joined_counts(V.table_counts({t: lake.table(t) for t in _NINE}), _NINE)


@query("v05_histogram_by_op", order_sql("SELECT op AS __op, count(*) AS n FROM ch GROUP BY op"))
def histogram(lake: Lake) -> DataFrame:
    return V.op_histogram(order_history(lake))


@query(
    "v06_conditional_counts",
    order_sql("""
SELECT count(*) FILTER (WHERE op = 'd') AS deleted, count(*) FILTER (WHERE op = 'r') AS snapshot_reads, count(*) FILTER (WHERE status = 'reopened') AS reopened FROM ch"""),
)
def conditional(lake: Lake) -> DataFrame:
    conditions = {
        "deleted": F.lower("__deleted") == "true",
        "snapshot_reads": F.col("__op") == "r",
        "reopened": F.col("status") == "reopened",
    }
    return V.count_where(order_history(lake), conditions)


@query("v07_distinct_values", order_sql("SELECT DISTINCT amount FROM ch WHERE amount IS NOT NULL ORDER BY 1"))
def distinct_values(lake: Lake) -> DataFrame:
    return V.distinct_values(changes(lake).filter("amount IS NOT NULL"), "amount")


@query(
    "v08_expectations",
    order_sql("""
SELECT 'rows >= 3' AS rule, CAST(count(*) AS VARCHAR) AS found, count(*) >= 3 AS ok FROM ch
UNION ALL SELECT 'deletes > 0', CAST(count(*) FILTER (WHERE op = 'd') AS VARCHAR), count(*) FILTER (WHERE op = 'd') > 0 FROM ch
UNION ALL SELECT 'no unknown ops', CAST(count(*) FILTER (WHERE op NOT IN ('c', 'u', 'd', 'r')) AS VARCHAR), count(*) FILTER (WHERE op NOT IN ('c', 'u', 'd', 'r')) = 0 FROM ch"""),
)
def expectations(lake: Lake) -> DataFrame:
    known = F.col("__op").isin("c", "u", "d", "r")
    rules = {
        "rows >= 3": (F.count("*"), F.col("`rows >= 3`").cast("bigint") >= 3),
        "deletes > 0": (F.count_if(F.col("__op") == "d"), F.col("`deletes > 0`").cast("bigint") > 0),
        "no unknown ops": (F.count_if(~known), F.col("`no unknown ops`").cast("bigint") == 0),
    }
    return V.expectations(order_history(lake), rules)


@query(
    "v09_missing_names",
    shop_sql("SELECT table_name FROM (VALUES ('orders'), ('customers'), ('returns')) t(table_name) WHERE table_name <> 'orders' AND table_name <> 'customers'"),
)
def missing_names(lake: Lake) -> DataFrame:
    from tideline.functions.names import parse_topic

    found = lake.raw().select(parse_topic(F.col("topic"))["table"].alias("table_name")).distinct()
    expected = logs.literal(lake.spark, [("orders",), ("customers",), ("returns",)], "table_name string")
    return V.missing_names(found, expected, "table_name")


@query(
    "v10_partition_distribution",
    """
SELECT 'orders_' || strftime(o_orderdate, '%Y_%m') AS part, count(*) AS n, (SELECT count(DISTINCT date_trunc('month', o_orderdate)) FROM orders) AS total_partitions
FROM orders GROUP BY 1""",
)
def distribution(lake: Lake) -> DataFrame:
    parts = lake.partition_topics().withColumn("part", F.substring_index("topic", ".", -1))
    return V.partition_distribution(parts, "part").withColumn(
        "total_partitions", parts.agg(F.count_distinct("part").alias("p")).scalar()
    )


@query(
    "v11_exact_decimal",
    "SELECT count(*) FILTER (WHERE user_id = 5 AND event_id = 17) AS hits, count(*) FILTER (WHERE user_id = 5 AND event_id = 17) > 0 AS present FROM events",
)
def exact_decimal(lake: Lake) -> DataFrame:
    from tideline.plans.catalog_ingest import wide

    return V.has_exact(wide(lake, "as_fine_decimal"), "as_fine_decimal", "17.000000000000000005", "decimal(28,18)")


@query(
    "v12_conservation",
    """
WITH acc AS (SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total FROM customer)
SELECT CAST(2 AS BIGINT) AS versions, total AS lowest, total AS highest, true AS conserved FROM acc""",
)
def conservation(lake: Lake) -> DataFrame:
    before = lake.balances()
    after = A.transfer(before, lake.transfers())
    versions = before.withColumn("version", F.lit(0)).unionByName(after.withColumn("version", F.lit(1)))
    return V.conservation(versions, "version", "balance")


@query(
    "v13_numeric_text_sum",
    wire_sql("""
SELECT CAST(sum(CASE WHEN kind NOT IN (4, 9) THEN seq END) AS BIGINT) AS total, count(*) FILTER (WHERE kind NOT IN (4, 9)) AS numeric_rows FROM wire"""),
)
def numeric_text(lake: Lake) -> DataFrame:
    kind = F.col("offset") - F.floor(F.col("offset") / 20) * 20
    text = F.when(kind.isin(4, 9), "-").otherwise(F.col("offset").cast("string"))
    return V.numeric_text_sum(lake.order_raw().select(text.alias("committed")), "committed")


@query("v14_within_slack", order_sql("SELECT count(*) AS before, count(*) AS after, true AS ok FROM ch"))
def within_slack(lake: Lake) -> DataFrame:
    """A restart with no new data: applying an already applied log again adds no rows."""
    rows = lake.order_changes().agg(F.count("*"))
    again = order_history(lake).agg(F.count("*"))
    return V.within(rows, again, slack=2)


@query(
    "v15_converged",
    order_sql("SELECT 'orders' AS table_name, count(*) || '|' || CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS VARCHAR) AS source, count(*) || '|' || CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS VARCHAR) AS target, true AS equal FROM mirror"),
)
def converged(lake: Lake) -> DataFrame:
    return V.parity({"orders": mirror_by_time(lake)}, {"orders": mirror(lake)}, "amount")


@query(
    "v16_row_diff",
    order_sql("""
SELECT coalesce(m.id, o_orderkey) AS id, CASE WHEN m.id IS NULL THEN 'missing' ELSE 'changed' END AS difference
FROM orders LEFT JOIN mirror m ON m.id = o_orderkey
WHERE m.id IS NULL OR m.customer_id <> o_custkey OR m.amount <> CAST(o_totalprice AS DECIMAL(12,2)) OR m.status <> o_orderstatus"""),
)
def row_diff(lake: Lake) -> DataFrame:
    return V.row_diff(source_rows(lake), mirror(lake), ["id"])


# Orders of customers 1, 101, 201 ... were written late: these alone differ.
_LATE = "o_custkey % 100 = 1"


@query(
    "v16_row_diff_by_slice",
    f"""
SELECT CAST(o_orderkey AS BIGINT) AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'missing' WHEN o_orderkey % 3 = 1 THEN 'changed' END AS difference
FROM orders WHERE {_LATE} AND o_orderkey % 3 < 2 UNION ALL SELECT -o_orderkey, 'extra' FROM orders WHERE {_LATE} AND o_orderkey % 3 = 2""",
)
def row_diff_by_slice(lake: Lake) -> DataFrame:
    """A stored copy with some rows left out, some changed and some added; only rows of key slices that hold them are compared."""
    rows = source_rows(lake)
    late, turn = F.col("customer_id") % 100 == 1, F.pmod("id", F.lit(3))
    copy = rows.filter(~(late & (turn == 0))).withColumn("status", F.when(late & (turn == 1), F.lit("late")).otherwise(F.col("status")))
    extra = rows.filter(late & (turn == 2)).withColumn("id", -F.col("id"))
    target = A.stage(copy.unionByName(extra), lake.scratch("copy"))
    return V.row_diff_by_slice(rows, target, ["id"], slices=65_536)


@query(
    "v16_equal_slices",
    "SELECT count(*) AS n, CAST(count(*) AS BIGINT) AS same, CAST(0 AS BIGINT) AS slices FROM orders",
)
def equal_slices(lake: Lake) -> DataFrame:
    """Two copies in another order and layout: no slice differs."""
    rows = source_rows(lake)
    copy = A.stage(rows.repartition(5, "customer_id"), lake.scratch("copy"))
    parts = [(rows, "n"), (copy, "same"), (V.differing_slices(rows, copy, ["id"]), "slices")]
    counts = [df.agg(F.count("*").alias(name)) for df, name in parts]
    together = counts[0].unionByName(counts[1], allowMissingColumns=True).unionByName(counts[2], allowMissingColumns=True)
    return together.agg(*[F.sum(name).alias(name) for _, name in parts])


@query(
    "v17_fan_in_parity",
    shop_sql("""
SELECT 'public_orders' AS table_name, CAST(count(*) AS VARCHAR) AS source, CAST(count(*) AS VARCHAR) AS target, true AS equal FROM mirror
UNION ALL SELECT 'public_customers', CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR), true FROM cmirror"""),
)
def fan_in_parity(lake: Lake) -> DataFrame:
    people = A.apply_changes(None, lake.customer_changes().drop("topic", "partition", "ts_ms"), ["id"], ["offset"])
    return V.parity({"public_orders": mirror(lake), "public_customers": people}, routed_mirrors(lake))


# Q: audits ---------------------------------------------------------------------------------------


@query("q01_check", "SELECT c_custkey AS id, CAST(c_acctbal AS DECIMAL(12,2)) AS balance FROM customer WHERE NOT (c_acctbal >= 0)")
def check(lake: Lake) -> DataFrame:
    rows = lake.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").cast("decimal(12,2)").alias("balance"))
    return Q.check_violations(rows, "balance >= 0")


@query("q02_not_null", shop_sql("SELECT id, name FROM cmirror WHERE segment IS NULL"))
def not_null(lake: Lake) -> DataFrame:
    people = A.apply_changes(None, lake.customer_changes().drop("topic", "partition", "ts_ms"), ["id"], ["offset"])
    return Q.null_violations(people, "segment").select("id", "name")


@query(
    "q03_unique",
    "SELECT l_orderkey AS order_id, l_linenumber AS line, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def unique(lake: Lake) -> DataFrame:
    return Q.unique_violations(lake.line_changes(), ["order_id", "line"])


@query("q04_foreign_key", order_sql("SELECT id, customer_id FROM mirror WHERE customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"))
def foreign_key(lake: Lake) -> DataFrame:
    parents = lake.table("customer").filter("c_acctbal >= 0")
    return Q.fk_violations(mirror(lake), "customer_id", parents, "c_custkey").select("id", "customer_id")


@query(
    "q05_partition_range",
    """
SELECT o_orderkey AS id, 'orders_' || strftime(o_orderdate, '%Y_%m') AS part, o_orderdate + INTERVAL 3 DAY AS shipped_at FROM orders
WHERE date_trunc('month', o_orderdate + INTERVAL 3 DAY) <> date_trunc('month', o_orderdate)""",
)
def partition_range(lake: Lake) -> DataFrame:
    rows = lake.partition_topics().select(
        "id",
        F.substring_index("topic", ".", -1).alias("part"),
        (F.col("created_at") + F.expr("INTERVAL 3 DAYS")).alias("shipped_at"),
    )
    return Q.range_violations(rows, "shipped_at", "part", "orders_")


@query("q06_length", "SELECT o_orderkey AS id, o_orderpriority AS priority FROM orders WHERE length(o_orderpriority) > 8")
def length(lake: Lake) -> DataFrame:
    rows = lake.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"))
    return Q.length_violations(rows, "priority", 8)


@query(
    "q00_declared_audit",
    shop_sql("""
SELECT 'not_null:segment' AS rule, CAST(id AS VARCHAR) AS key, '' AS value FROM cmirror WHERE segment IS NULL
UNION ALL SELECT 'length:name', CAST(id AS VARCHAR), CAST(length(name) AS VARCHAR) FROM cmirror WHERE length(name) > 17
UNION ALL SELECT 'check:balance', CAST(id AS VARCHAR), 'balance <= 9000' FROM cmirror WHERE balance > 9000
UNION ALL SELECT 'unique:segment', segment, CAST(count(*) AS VARCHAR) FROM cmirror WHERE segment IS NOT NULL GROUP BY segment HAVING count(*) > 1
UNION ALL SELECT 'fk:id', CAST(id AS VARCHAR), CAST(id AS VARCHAR) FROM cmirror WHERE id NOT IN (SELECT o_custkey FROM orders)"""),
)
def declared_audit(lake: Lake) -> DataFrame:
    people = A.apply_changes(None, lake.customer_changes().drop("topic", "partition", "ts_ms"), ["id"], ["offset"])
    spec = TableSpec(
        "customers",
        ("id",),
        (Col("id", "bigint", nullable=False), Col("name", length=17), Col("segment", nullable=False), Col("balance", "decimal(12,2)")),
        checks={"balance": "balance <= 9000"},
        unique=(("segment",),),
        fks=(ForeignKey("id", "orders", "o_custkey"),),
    )
    return Q.audit(people, spec, {"orders": lake.table("orders")})
