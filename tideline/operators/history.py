"""Append-only history tables and the latest-row view over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.spec import TableSpec


def append_history(flat: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """One row per event, appended; ``partition_by`` names columns such as the event date.

    Rows are rebalanced by those columns first: few files per folder, and a folder with much of the
    data is written by several tasks.
    """
    rows = flat.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else flat
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Every column any file has; rows older than a column read it as null."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def latest_view(history: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Newest row per key, without keys whose newest row is a delete.

    The delete flag is tested after ranking, and a missing flag counts as not deleted. ``order`` needs
    a final tie-break (the log offset): the millisecond timestamp alone is not a total order.
    """
    newest = Window.partitionBy(*keys).orderBy(*order)
    return (
        history.withColumn("_rn", F.row_number().over(newest))
        .filter((F.col("_rn") == 1) & (F.coalesce(F.col("__deleted"), F.lit("false")) != "true"))
        .drop("_rn")
    )


def create_target(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """An empty table with the declared columns, ready for the first append."""
    spark.createDataFrame([], spec.struct_type()).write.mode("ignore").parquet(path)
    return spark.read.schema(spec.struct_type()).parquet(path)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union over added columns: rows from before a column existed hold null in it."""
    return old.unionByName(new, allowMissingColumns=True)
