"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings the operators rely on or gain from; sizes stay with the cluster's own defaults."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a hot key's join even where that costs one more shuffle afterwards.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Building a plan is quicker without a captured stack per expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )


def pin_utc(spark: SparkSession) -> None:
    """Wire times are UTC, so zone-less timestamps must be read as UTC too."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def split_skewed_joins(spark: SparkSession) -> None:
    """Split a hot key's join even where that costs one more shuffle afterwards."""
    if spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") != "true":
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where that is unset, scratch goes to the session's warehouse, which is shared by its own purpose.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark)}/tideline/{name}-{uuid.uuid4().hex}"
