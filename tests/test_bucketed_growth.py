"""Compactions of a growing bucketed mirror: ever rarer, and the state stays whole."""

from pyspark.sql import functions as F
from tests.helpers import rows
from tests.test_bucketed import frame, table


def test_a_growing_base_is_not_rewritten_by_every_batch(spark, tmp_path):
    mirror = table(tmp_path, compact_bytes=1, small_base=0)

    def batch(first, n, op="c"):
        return spark.range(first, first + n).selectExpr("id", "sha2(string(id), 256) AS v", f"'{op}' AS op", "1000000 + id AS offset")

    mirror.write_batch(batch(0, 60_000), 0)
    for k in (1, 2):
        mirror.write_batch(batch(60_000 + 300 * k, 300).unionByName(batch(k, 1, "d").withColumn("offset", F.col("offset") + 1_000_000)), k)
        assert mirror._versions(spark)[0] == 0 and mirror.pending_bytes(spark) > 1  # a small share of the base waits
    mirror.write_batch(batch(100_000, 30_000), 3)
    assert mirror._versions(spark)[0] == 1 and mirror.pending_bytes(spark) == 0
    got = mirror.read(spark)
    assert got.count() == 60_000 + 600 + 30_000 - 2 and got.filter("id IN (1, 2)").isEmpty()


def test_the_size_of_the_base_is_that_of_the_versions_that_hold(spark, tmp_path):
    mirror = table(tmp_path)
    assert mirror.base_bytes(spark) == 0
    mirror.write_batch(frame(spark, [(i, "x", "c", i) for i in range(100)]), 0)
    mirror.compact(spark)
    first = mirror.base_bytes(spark)
    mirror.write_batch(frame(spark, [(i, "y", "u", 1000 + i) for i in range(100)]), 1)
    mirror.compact(spark)
    assert first > 0 and abs(mirror.base_bytes(spark) - first) < first // 2  # the old versions do not count
    assert sorted(rows(mirror.read(spark))) == [(i, "y") for i in range(100)]
