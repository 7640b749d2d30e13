"""Queries that build and read the customer-order graph (G)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators import graph as G
from tideline.plans.feeds import Lake, shop_sql
from tideline.plans.registry import query

CUSTOMER_PROPS = ["name", "segment", "balance"]
ORDER_PROPS = ["amount", "status"]

# Topic names decide ties in event time: customers sort before orders.
_NODES = """, last_c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, seq DESC) AS rn FROM cch) WHERE rn = 1),
ref AS (SELECT customer_id AS id, max(ts_ms) AS ref_ms FROM ch WHERE op <> 'd' GROUP BY 1),
gone AS (SELECT id, max(ts_ms) AS gone_ms FROM cch WHERE op = 'd' GROUP BY 1),
cnode AS (
  SELECT id, CASE WHEN l.op <> 'd' THEN name END AS name, CASE WHEN l.op <> 'd' THEN segment END AS segment,
    CASE WHEN l.op <> 'd' THEN CAST(balance AS DECIMAL(12,2)) END AS balance, coalesce(l.op = 'd', true) AS placeholder
  FROM last_c l FULL JOIN ref USING (id) LEFT JOIN gone USING (id)
  WHERE coalesce(l.op <> 'd', false) OR (ref_ms IS NOT NULL AND (gone_ms IS NULL OR ref_ms >= gone_ms))),
onode AS (SELECT id, amount, status FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, seq DESC) AS rn FROM ch) WHERE rn = 1 AND op <> 'd'),
edge AS (
  SELECT DISTINCT e.customer_id AS src, e.id AS dst FROM ch e WHERE e.op <> 'd'
  AND NOT EXISTS (SELECT 1 FROM ch d WHERE d.id = e.id AND d.op = 'd' AND (d.ts_ms > e.ts_ms OR (d.ts_ms = e.ts_ms AND d.seq > e.seq)))
  AND NOT EXISTS (SELECT 1 FROM cch d WHERE d.id = e.customer_id AND d.op = 'd' AND d.ts_ms > e.ts_ms)),
current_edge AS (
  SELECT e.customer_id AS src, e.id AS dst FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, seq DESC) AS rn FROM ch) e WHERE rn = 1 AND op <> 'd'
  AND NOT EXISTS (SELECT 1 FROM cch d WHERE d.id = e.customer_id AND d.op = 'd' AND d.ts_ms > e.ts_ms))
"""


def graph_sql(body: str) -> str:
    return shop_sql(_NODES + body)


def order_log(lake: Lake) -> DataFrame:
    return lake.order_changes().drop("partition")


def customer_log(lake: Lake) -> DataFrame:
    return lake.customer_changes().drop("partition")


def customers(lake: Lake) -> DataFrame:
    refs = G.references(order_log(lake), "customer_id")
    return G.nodes_with_placeholders(customer_log(lake), refs, CUSTOMER_PROPS)


def orders(lake: Lake) -> DataFrame:
    return G.nodes(order_log(lake), ORDER_PROPS)


def edges(lake: Lake, mode: str = "accumulate") -> DataFrame:
    return G.edges(order_log(lake), "customer_id", customer_log(lake), mode)


@query("g01_nodes", graph_sql("SELECT id, amount, status FROM onode"))
def nodes(lake: Lake) -> DataFrame:
    return orders(lake)


@query("g01_nodes_null_clears", shop_sql("SELECT id, name, segment, balance FROM cmirror"))
def null_clears(lake: Lake) -> DataFrame:
    return G.nodes(customer_log(lake), CUSTOMER_PROPS)


@query("g02_edges", graph_sql("SELECT src, dst FROM edge"))
def edges_accumulate(lake: Lake) -> DataFrame:
    return edges(lake)


@query("g02_edges_current", graph_sql("SELECT src, dst FROM current_edge"))
def edges_current(lake: Lake) -> DataFrame:
    return edges(lake, "current")


@query("g03_placeholder_nodes", graph_sql("SELECT id, name, segment, balance, placeholder FROM cnode"))
def placeholders(lake: Lake) -> DataFrame:
    return customers(lake)


@query(
    "g04_detach_delete",
    graph_sql("SELECT src, dst FROM edge WHERE src NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)"),
)
def detach(lake: Lake) -> DataFrame:
    leaving = lake.table("customer").filter("c_nationkey = 3").select(F.col("c_custkey").alias("id"))
    return G.detached(edges(lake), leaving, "src")


@query(
    "g05_counts",
    graph_sql("""
SELECT 'Customer' AS label, count(*) AS n FROM cnode UNION ALL SELECT 'Order', count(*) FROM onode UNION ALL SELECT 'PLACED', count(*) FROM edge"""),
)
def counts(lake: Lake) -> DataFrame:
    return G.counts({"Customer": customers(lake), "Order": orders(lake), "PLACED": edges(lake)})


@query("g05_degree", graph_sql("SELECT src, count(*) AS degree FROM edge GROUP BY src"))
def degree(lake: Lake) -> DataFrame:
    return G.degree(edges(lake))


@query(
    "g06_pattern_match",
    graph_sql("""
SELECT src, dst, c.name AS source_name, o.amount AS target_amount, o.status AS target_status
FROM edge JOIN cnode c ON c.id = src JOIN onode o ON o.id = dst"""),
)
def pattern(lake: Lake) -> DataFrame:
    return G.match(customers(lake), edges(lake), orders(lake), ["name"], ORDER_PROPS)


@query("g07_numeric_property", graph_sql("SELECT id, CAST(amount AS DOUBLE) AS amount, status FROM onode"))
def numeric(lake: Lake) -> DataFrame:
    text = orders(lake).withColumn("amount", F.col("amount").cast("string"))
    return G.numeric_property(text, "amount")
