"""Change logs, snapshots and small generated row sources.

A raw log is ``(topic, partition, offset, ts, key, value)``; ``ts`` is the append time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.names import full_match

RAW_SCHEMA = "topic string, partition int, offset bigint, ts timestamp, key string, value string"


def read_log(
    spark: SparkSession,
    path: str,
    topics: Sequence[str] | None = None,
    topics_regex: str | None = None,
    streaming: bool = False,
    starting: str = "earliest",
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Log files from the beginning, as a batch or a stream.

    ``starting`` accepts only ``earliest``: where a stream resumes is its checkpoint's business. The
    schema is fixed, so new fields inside ``value`` never change the stream's own schema.
    """
    if starting != "earliest":
        raise ValueError("a file log is read from the earliest record")
    reader = (spark.readStream if streaming else spark.read).format(fmt).schema(RAW_SCHEMA)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return subscribe(reader.load(path), topics, topics_regex)


def kafka_options(servers: str, topics: Sequence[str] | None = None, topics_regex: str | None = None, starting: str = "earliest") -> dict[str, str]:
    if (topics is None) == (topics_regex is None):
        raise ValueError("give either topics or a pattern")
    chosen = {"subscribe": ",".join(topics)} if topics is not None else {"subscribePattern": topics_regex}
    return {"kafka.bootstrap.servers": servers, "startingOffsets": starting, **chosen}


def read_kafka(
    spark: SparkSession, servers: str, topics: Sequence[str] | None = None, topics_regex: str | None = None, streaming: bool = True
) -> DataFrame:
    """The same raw rows from a broker; needs the Spark Kafka package on the class path."""
    options = kafka_options(servers, topics, topics_regex)
    rows = (spark.readStream if streaming else spark.read).format("kafka").options(**options).load()
    return rows.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("ts"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def subscribe(df: DataFrame, topics: Sequence[str] | None = None, regex: str | None = None) -> DataFrame:
    """Keep listed topics, or topics a pattern wholly matches; everything when neither is given."""
    if topics is not None:
        df = df.filter(F.col("topic").isin(*topics))
    if regex is not None:
        df = df.filter(full_match(F.col("topic"), regex))
    return df


def snapshot(df: DataFrame) -> DataFrame:
    """Existing rows of a table as ``r`` changes."""
    return df.withColumn("op", F.lit("r"))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A target, lake table or directory of table partitions read back."""
    return spark.read.option("mergeSchema", "true").format(fmt).load(path)


def jdbc_partition_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options that split a JDBC table read over many tasks instead of one."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties).load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 1000, writers: int | None = None) -> None:
    """Set-based batch append: each task sends its rows in statements of ``batch_size`` rows.

    A retried task appends again, so ``table`` should be a staging table that is merged by key afterwards. ``writers``
    bounds the connections without drawing the work before it into as few tasks.
    """
    rows = df.repartition(writers) if writers else df
    rows.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size).options(
        **properties
    ).mode("append").save()


def series(spark: SparkSession, low: int, high: int) -> DataFrame:
    """``i`` from low to high, both included, split over the cluster."""
    return spark.range(low, high + 1).withColumnRenamed("id", "i")


def series_per_row(df: DataFrame, low: Column, high: Column, name: str = "i") -> DataFrame:
    """One row per number in [low, high] beside each input row; none where low exceeds high."""
    numbers = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(name, F.explode(numbers))


def grid(df: DataFrame, axes: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Nested loops: every combination of the axes beside each input row, generated in place."""
    for name, (low, high) in axes.items():
        df = df.withColumn(name, F.explode(F.sequence(low, high)))
    return df


def literal(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
