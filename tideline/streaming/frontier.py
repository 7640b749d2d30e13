"""Rows of a stream held back until every partition of their topic has resolved their time."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.apply import progress
from tideline.streaming.run import is_missing


@dataclass(frozen=True)
class FrontierRelease:
    """Releases each row in the batch in which its topic's frontier reaches the row's time, once.

    The frontier of a topic is the smallest mark over its partitions, each partition's mark being the latest it has sent. It only
    moves forward. ``partitions`` says how many partitions a topic has: until all have sent a mark nothing of the topic is
    released. For a topic not named there the partitions seen so far count.

    Batch ``N`` writes three folders: ``held/batch_id=N`` with rows still ahead of their frontier, cut into time buckets of ``width``,
    ``released/batch_id=N``, and last ``marks/batch_id=N`` with the marks so far. A held row is written once. When the frontier
    moves from ``a`` to ``b``, only the buckets between are read, and of those the rows with ``a < time <= b``; a stalled frontier reads none. A retried batch starts from the marks of the one
    before and replaces its own folders, so nothing is released twice or lost.

    Frontiers reach the rows as literals, at most ``most_topics`` of them; the log is not joined. Rows without a time are never released.
    """

    path: str
    time: str = "ts_ms"
    mark: str = "frontier"  # column of ``progress`` that has the unit of ``time``
    partitions: Mapping[str, int] | None = None
    width: int = 86_400_000
    most_topics: int = 1_000

    def write_batch(self, raw: DataFrame, rows: DataFrame, batch_id: int) -> None:
        """``rows`` are what ``raw`` decodes to: ``topic``, the time and whatever is to be released."""
        spark = raw.sparkSession
        before = self.marks(spark, batch_id - 1)
        new = progress(raw).filter(F.col(self.mark).isNotNull()).select("topic", "partition", F.col(self.mark).alias("mark"))
        both = new if before is None else before.unionByName(new, allowMissingColumns=True)
        if before is None:
            both = both.withColumn("passed", F.lit(None).cast(both.schema["mark"].dataType))
        marks = both.groupBy("topic", "partition").agg(F.max("mark").alias("mark"), F.max("passed").alias("passed"))
        moved = self.frontiers(marks).limit(self.most_topics + 1).collect()
        if len(moved) > self.most_topics:
            raise ValueError(f"more than {self.most_topics} topics: run one release for each group of topics")
        now = self._by_topic({r.topic: r.now for r in moved})
        ready = F.coalesce(F.col(self.time) <= now, F.lit(False))
        bucket = F.floor(F.col(self.time) / F.lit(self.width)).cast("bigint")
        rows.filter(~ready).withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/held/batch_id={batch_id}")
        released = rows.filter(ready)
        ranges = [r for r in moved if r.was is None or r.was < r.now]
        waiting = self.held(spark, rows, batch_id) if ranges and batch_id > 0 else None
        if waiting is not None:
            released = released.unionByName(waiting.filter(reduce(Column.__or__, map(self._passed, ranges))).select(*rows.columns))
        released.write.mode("overwrite").parquet(f"{self.path}/released/batch_id={batch_id}")
        marks.withColumn("passed", now.cast(marks.schema["mark"].dataType)).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/batch_id={batch_id}")

    def _passed(self, r) -> Column:
        """Rows of one topic that its frontier passes in this batch; the bucket bounds prune folders."""
        inside = (F.col("topic") == r.topic) & (F.col(self.time) <= F.lit(r.now)) & (F.col("bucket") <= int(r.now // self.width))
        return inside if r.was is None else inside & (F.col(self.time) > F.lit(r.was)) & (F.col("bucket") >= int(r.was // self.width))

    def _by_topic(self, values: Mapping[str, object]) -> Column:
        if not values:
            return F.lit(None).cast("bigint")
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("topic")]

    def frontiers(self, marks: DataFrame) -> DataFrame:
        """``(topic, was, now)`` of topics that have a frontier; it is never behind the one already passed."""
        want = F.coalesce(self._by_topic(dict(self.partitions)), F.lit(0)) if self.partitions else F.lit(0)
        found = marks.groupBy("topic").agg(F.min("mark").alias("_least"), F.max("passed").alias("was"), F.count("*").alias("_n"))
        now = F.greatest("was", F.when(F.col("_n") >= want, F.col("_least")))
        return found.select("topic", "was", now.alias("now")).filter("now IS NOT NULL")

    def marks(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Latest mark of each partition after a batch and the frontier its topic has passed; of the newest earlier batch where that one wrote none."""
        try:
            return spark.read.parquet(f"{self.path}/marks/batch_id={batch_id}")
        except AnalysisException as error:
            if not is_missing(error):
                raise
        try:
            known = spark.read.parquet(f"{self.path}/marks").filter(F.col("batch_id") <= batch_id)
        except AnalysisException as error:
            if not is_missing(error):
                raise
            return None
        last = known.agg(F.max("batch_id")).head()[0]
        return None if last is None else known.filter(F.col("batch_id") == last).drop("batch_id")

    def held(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> DataFrame | None:
        """Rows that batches before ``batch_id`` held back, whether released since or not."""
        schema = rows.withColumn("bucket", F.lit(0).cast("bigint")).withColumn("batch_id", F.lit(0).cast("bigint")).schema
        try:
            found = spark.read.schema(schema).option("basePath", f"{self.path}/held").parquet(f"{self.path}/held")
        except AnalysisException as error:
            if not is_missing(error):
                raise
            return None
        return found.filter(F.col("batch_id") < batch_id)

    def waiting(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> DataFrame:
        """Rows still held after a batch; ``rows`` gives the columns."""
        every = self.held(spark, rows, batch_id + 1)
        marks = self.marks(spark, batch_id)
        if every is None:
            return rows.limit(0)
        passed = {} if marks is None else {r.topic: r.passed for r in marks.filter("passed IS NOT NULL").select("topic", "passed").distinct().collect()}
        late = ~F.coalesce(F.col(self.time) <= self._by_topic(passed), F.lit(False))
        return every.filter(late).select(*rows.columns)
