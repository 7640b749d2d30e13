"""The bucketed mirror: the same state as any mirror, without an exchange, rewriting only what changes touch."""

import random

import pytest
from tests.helpers import rows
from tests.test_plans import final_plan
from tests.test_properties import random_log, replay
from pyspark.sql import functions as F

from tideline.streaming.bucketed import BucketedMirror

SCHEMA = {"id": "bigint", "v": "string", "op": "string", "offset": "bigint"}


def table(tmp_path, **how):
    return BucketedMirror(str(tmp_path / "m"), ("id",), ("offset",), SCHEMA, buckets=4, slots=4, **how)


def frame(spark, events):
    return spark.createDataFrame(events, "id long, v string, op string, offset long")


@pytest.mark.parametrize("compact", ["never", "each", "by bytes"])
def test_state_equals_replay(spark, tmp_path, compact):
    log = random_log(4, n=300)
    late = log[:]
    random.Random(1).shuffle(late)
    mirror = table(tmp_path, compact_bytes=3_000 if compact == "by bytes" else None)
    for k in range(6):
        part = frame(spark, late[k * 50 : k * 50 + 50])
        for _ in range(2):  # delivered twice
            mirror.write_batch(part, k)
        if compact == "each":
            mirror.compact(spark)
    assert sorted(rows(mirror.read(spark), "id", "v")) == replay(log)
    if compact == "by bytes":
        assert mirror._versions(spark)[0] >= 0 and mirror.pending_bytes(spark) <= 3_000
    mirror.write_batch(frame(spark, late[:100]), 7)  # an old redelivery loses, against deletes too
    assert sorted(rows(mirror.read(spark), "id", "v")) == replay(log)


def test_nothing_is_exchanged_and_the_base_is_read_once(spark, tmp_path):
    mirror = table(tmp_path)
    mirror.write_batch(frame(spark, [(i, "x", "c", i) for i in range(500)]), 0)
    mirror.compact(spark)
    for k in (1, 2):
        mirror.write_batch(frame(spark, [(i, "y", "u", 1000 * k + i) for i in range(20)]), k)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = mirror.read(spark)
        text = final_plan(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in text and "SortMergeJoin" in text
    assert text.count("FileScan parquet") == 2 and "SelectedBucketsCount: 4 out of 4" in mirror.read(spark)._jdf.queryExecution().toString()
    assert got.count() == 500 and got.filter("v = 'y'").count() == 20


def test_only_touched_slots_are_rewritten(spark, tmp_path):
    mirror = table(tmp_path)
    mirror.write_batch(frame(spark, [(i, "x", "c", i) for i in range(100)]), 0)
    assert mirror.compact(spark) == 0 and mirror.compact(spark) == 0
    assert mirror._versions(spark) == (0, dict.fromkeys(range(4), 0))
    mirror.write_batch(frame(spark, [(5, "y", "u", 1000)]), 1)
    slot = spark.createDataFrame([(5,)], "id long").select(mirror._slot()).head()[0]
    assert mirror.compact(spark) == 1
    assert mirror._versions(spark) == (1, {s: int(s == slot) for s in range(4)})
    assert mirror.read(spark).filter("v = 'y'").count() == 1 and mirror.read(spark).count() == 100
    assert mirror.changes(spark).count() == 0


def test_a_compaction_that_is_lost_before_its_record_changes_nothing(spark, tmp_path):
    mirror = table(tmp_path)
    mirror.write_batch(frame(spark, [(1, "x", "c", 1)]), 0)
    merged = mirror.state(spark).withColumns({"version": F.lit(0).cast("bigint"), "slot": mirror._slot()})
    mirror._insert(merged, "base", "version", "slot")
    assert rows(mirror.read(spark)) == [(1, "x")] and mirror._versions(spark) == (-1, {})
    mirror.compact(spark)
    assert rows(mirror.read(spark)) == [(1, "x")]


def test_a_new_session_finds_the_buckets(spark, tmp_path):
    mirror = table(tmp_path)
    mirror.write_batch(frame(spark, [(1, "x", "c", 1), (2, None, "d", 2)]), 0)
    for kind in ("changes", "base"):
        spark.sql(f"DROP TABLE IF EXISTS {mirror._table(spark, kind)}")  # leaves the files: the tables have a location of their own
    assert rows(mirror.read(spark)) == [(1, "x")]
