"""A streamed batch is parsed once for all its tables, and keeps little; the raw log is the same however it is written."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tests.helpers import NARROW, raw, rows, value
from tests.test_plans import DATA

from tideline.plans import flow
from tideline.plans.feeds import Lake
from tideline.sources.logs import read_log
from tideline.spec import Col, FlowSpec, TableSpec

OTHER = TableSpec("other", ("code",), (Col("code"), Col("n", "bigint", "int")))
DECLARED = FlowSpec(tables={"orders": NARROW, "other": OTHER}, table_template="${source.table}")


def mixed(spark):
    own = [
        ({"id": 1}, value("c", {"id": 1, "amount": "1.00"})),
        ({"id": 1}, value("u", {"id": 1, "amount": "2.00"}, wrapped=True, source={"table": "orders"})),
        ({"id": 2}, value("u", {"id": 2, "amount": "much"})),
        ({"id": 3}, "broken {"),
        ({"id": 4}, None),
        ({"id": 4}, " \t"),
        (None, value("c", {"amount": "1.00"})),
    ]
    log = raw(spark, own).union(raw(spark, [({"code": "a"}, value("c", {"code": "a", "n": 7})), (None, value("c", {"code": "b", "n": "x"}))], topic="shop.public.other"))
    return log.union(raw(spark, [({"id": 1}, value("c", {"id": 1})), ({"id": 1}, None)], topic="shop.public.nowhere"))


@pytest.mark.parametrize("at_once", [1, 16])
def test_every_row_ends_in_its_table_or_its_quarantine(spark, tmp_path, at_once):
    log = mixed(spark)
    log.write.parquet(f"{tmp_path}/log")
    running, tables = flow.run_stream(read_log(spark, f"{tmp_path}/log", streaming=True), DECLARED, f"{tmp_path}/out", at_once=at_once)
    running.awaitTermination()
    assert [(r.id, str(r.amount)) for r in tables["orders"].read(spark).collect()] == [(1, "2.00")]
    assert rows(tables["other"].read(spark)) == [("a", 7)]

    def kept(name):
        found = spark.read.parquet(flow.quarantine_path(f"{tmp_path}/out", name))
        assert found.columns == ["topic", "partition", "offset", "key", "value", "reason", "batch_id"]
        assert found.filter("value IS NULL").isEmpty()
        return rows(found, "offset", "reason")

    assert kept("orders") == [(2, "bad_value:amount"), (3, "unparsable"), (6, "no_key")]
    assert kept("other") == [(1, "bad_value:n")]
    assert kept(flow.UNKNOWN_TABLE) == [(0, "unknown_table")]


def test_a_value_is_parsed_once_and_usable_rows_leave_their_text_behind(spark):
    batch = flow.sorted_out(flow.prepared(mixed(spark), DECLARED, parsed=True), DECLARED.tables, ("partition", "offset"))
    plan = batch._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") <= 3  # the value, and a key for each table
    usable = batch.filter("reason IS NULL")
    assert usable.count() == 3 and usable.filter("key IS NOT NULL OR value IS NOT NULL").isEmpty()


def test_the_written_log_is_the_log(spark):
    lake = Lake(spark, DATA)
    written = read_log(spark, lake.raw_files(7))
    assert written.exceptAll(lake.raw()).isEmpty() and lake.raw().exceptAll(written).isEmpty()


def test_many_tasks_can_share_a_log_file(spark, tmp_path):
    text = F.concat(*[F.sha2(F.concat("id", F.lit(str(k))), 512) for k in range(4)])
    Lake.write_log(spark.range(60_000).select(text.alias("value")).coalesce(1), f"{tmp_path}/log")
    (file,) = glob.glob(f"{tmp_path}/log/*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups > 2
