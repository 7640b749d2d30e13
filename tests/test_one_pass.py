"""All tables of a flow from one pass over the log; merged topics in hybrid time."""

import re

import pytest
from tests.helpers import NARROW, raw, rows, value
from tests.test_plans import DATA, final_plan
from pyspark.sql import functions as F

from tideline.operators import apply as A
from tideline.operators import route as R
from tideline.operators import verify as V
from tideline.plans import flow
from tideline.plans.feeds import CUSTOMERS_SPEC, ORDERS_SPEC, SUPPLIERS_SPEC, Lake
from tideline.sources.logs import read_log
from tideline.spec import Col, FlowSpec, Step, TableSpec

SPECS = {"orders": ORDERS_SPEC, "customers": CUSTOMERS_SPEC, "suppliers": SUPPLIERS_SPEC}


def named(spark):
    lake = Lake(spark, DATA)
    return flow.prepared(read_log(spark, lake.raw_files()), FlowSpec(tables=SPECS, table_template="${source.table}")), lake


def test_one_scan_for_three_tables(spark):
    log, _ = named(spark)
    mirrors = flow.apply_tables_once(log, SPECS, ["partition", "offset"])
    text = final_plan(V.table_counts(mirrors))
    assert len(re.findall(r"FileScan parquet|Scan parquet", text)) == 1
    assert len(re.findall(r"ReusedExchange", text)) == 2


@pytest.mark.parametrize("at_once", [1, 2, 16])
@pytest.mark.parametrize("staged", [True, False])
def test_same_tables_as_one_by_one(spark, at_once, staged):
    log, lake = named(spark)
    mirrors = flow.apply_tables_once(log, SPECS, ["partition", "offset"], lake.scratch("staged") if staged else None, at_once)
    for name, spec in SPECS.items():
        alone = A.apply_changes(None, flow.flat_changes(log.filter(F.col("target") == name), spec), spec.keys, ["partition", "offset"])
        assert mirrors[name].schema.names == alone.schema.names
        assert mirrors[name].exceptAll(alone).isEmpty() and alone.exceptAll(mirrors[name]).isEmpty()


def test_a_staged_pass_reads_only_the_folder_of_its_table(spark):
    log, lake = named(spark)
    mirror = flow.apply_tables_once(log, SPECS, ["partition", "offset"], lake.scratch("staged"))["customers"]
    text = final_plan(mirror)
    assert "PartitionFilters: [isnotnull(table" in text and "Exchange" not in text


def test_keys_of_any_type_and_unusable_events(spark):
    fine = TableSpec("fine", ("at", "name"), (Col("at", "timestamp_ntz", "micro_timestamp"), Col("name"), Col("v", "bigint", "int")))
    k = [{"at": 1_700_000_000_000_001 + i, "name": "x"} for i in range(2)]
    log = raw(spark, [(k[0], value("c", {**k[0], "v": 1})), (k[1], value("c", {**k[1], "v": 2})), (k[1], value("u", {**k[1], "v": "no number"})), (None, "broken {"), (k[0], None)], topic="shop.public.fine")
    log = log.union(raw(spark, [({"id": 1}, value("c", {"id": 1, "amount": "2.00"})), ({"id": 1}, value("u", {"id": 1, "amount": "bad"})), ({"id": 2}, value("d"))]))
    log = log.union(raw(spark, [({"id": 1}, value("c", {"id": 1}))], topic="shop.public.unknown"))
    out = flow.run_batch(log, FlowSpec(tables={"fine": fine, "orders": NARROW}, table_template="${source.table}"))
    assert rows(out["fine"].select("name", "v")) == [("x", 1), ("x", 2)]
    assert [(r.id, str(r.amount)) for r in out["orders"].collect()] == [(1, "2.00")]


def test_a_sink_gets_every_table(spark):
    seen = {}
    log = raw(spark, [({"id": 1}, value("c", {"id": 1, "amount": "2.00"}))])
    flow.run_batch(log, FlowSpec(tables={"orders": NARROW}, table_template="${source.table}", sinks=[lambda n, df: seen.update({n: df.count()})]))
    assert seen == {"orders": 1}


@pytest.mark.parametrize("forms", [[{"ts_ns": 7_000_001}, {"ts_ns": 7_000_002}], [{"updated": "7000000.0000000001"}, {"updated": "7000000.0000000002"}], [{}, {"source": {"ts_hlc": "7000000.0000000001"}}]])
def test_moves_between_topics_within_a_millisecond(spark, forms):
    left = raw(spark, [({"id": 1}, value("c", {"id": 1, "amount": "1.00"}, ts_ms=6))] * 5 + [({"id": 1}, value("d", ts_ms=7, **forms[0]))], topic="shop.public.orders_2024_05")
    came = raw(spark, [({"id": 1}, value("c", {"id": 1, "amount": "2.00"}, ts_ms=7, **forms[1]))], topic="shop.public.orders_2024_04")
    merge = Step("merge", R.merge_partitions, {"pattern": r"shop\.public\.orders_.*", "target": "shop.public.orders"})
    declared = FlowSpec(transforms=[merge], tables={"orders": NARROW}, table_template="${source.table}")
    assert flow.order_of(declared)[0] == "clock"
    assert [str(r.amount) for r in flow.run_batch(left.union(came), declared)["orders"].collect()] == ["2.00"]
