"""Plans must keep their shape: what is pushed down, shuffled, broadcast and parsed."""

import re

from pyspark.sql import functions as F

from tideline.operators import apply as A
from tideline.operators.classify import classify
from tideline.plans import catalog
from tideline.plans.catalog_graph import edges
from tideline.plans.feeds import ORDERS, ORDERS_SPEC, Lake
from tideline.sources.logs import read_log
from tideline.streaming.mirror import MirrorTable

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_point_lookup_is_pushed_to_the_scan(spark):
    text = plan(catalog.QUERIES["f07_equality"](spark, DATA))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>", text)


def test_each_event_is_parsed_once(spark):
    lake = Lake(spark, DATA)
    log = read_log(spark, lake.raw_files(6), topics=[ORDERS])
    for frame in classify(log, ORDERS_SPEC):
        text = frame.select("offset", "id.id")._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"parseJson\(value#", text)) == 1


def test_topic_filter_reaches_the_scan(spark):
    lake = Lake(spark, DATA)
    text = plan(read_log(spark, lake.raw_files(6), topics=[ORDERS]).select("offset"))
    assert f"EqualTo(topic,{ORDERS})" in text and "ReadSchema: struct<topic:string,offset:bigint>" in text


def test_small_changes_do_not_move_the_target(spark, tmp_path):
    path = str(tmp_path / "big")
    spark.range(50_000).select("id", F.col("id").alias("v")).write.parquet(path)
    target = spark.read.parquet(path)
    changes = spark.createDataFrame([(5, 1, "u", 1), (6, None, "d", 2)], "id long, v long, op string, offset long")
    got = A.apply_changes(target, changes, ["id"], ["offset"], staging=str(tmp_path / "reduced"))
    text = final_plan(got)
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert "Exchange hashpartitioning" not in text
    assert got.count() == 49_999


def test_compacted_base_is_not_shuffled(spark, tmp_path):
    table = MirrorTable(str(tmp_path / "m"), ("id",), ("offset",), "id bigint, v string, op string, offset bigint")
    big = spark.range(20_000).select("id", F.lit("x").alias("v"), F.lit("c").alias("op"), F.col("id").alias("offset"))
    table.write_batch(big, 0)
    table.compact(spark)
    table.write_batch(big.filter("id < 5").withColumn("offset", F.lit(10**9)).withColumn("v", F.lit("y")), 1)
    got = table.read(spark)
    text = plan(got)
    assert "SortMergeJoin" not in text and text.count("+- BroadcastHashJoin") + text.count(":- BroadcastHashJoin") == 2
    assert got.count() == 20_000 and got.filter("v = 'y'").count() == 5


def test_no_cartesian_products(spark):
    for name in ("g02_edges", "g06_pattern_match", "v16_row_diff", "a12_resnapshot", "s13_grid", "st09_hop_throughput", "a17_running_balance"):
        text = plan(catalog.QUERIES[name](spark, DATA))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_reduction_aggregates_before_the_shuffle(spark):
    text = plan(catalog.QUERIES["a01_reduce_latest"](spark, DATA))
    assert text.index("partial_max_by") > text.index("Exchange hashpartitioning")
    assert "partial_max" in plan(edges(Lake(spark, DATA)))


def test_latest_view_limits_groups_before_the_shuffle(spark):
    text = plan(catalog.QUERIES["a07_latest_view"](spark, DATA))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_no_python_rows_in_the_hot_path(spark):
    for name in ("a04_mirror_from_wire", "t02_decimal_bytes", "s11_extract_metrics", "g03_placeholder_nodes"):
        text = plan(catalog.QUERIES[name](spark, DATA))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name
