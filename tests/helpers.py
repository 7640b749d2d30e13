"""Small builders for raw logs used by several tests."""

import json

from pyspark.sql import DataFrame, SparkSession

from tideline.sources.logs import RAW_SCHEMA
from tideline.spec import Col, TableSpec

NARROW = TableSpec(
    "orders",
    ("id",),
    (Col("id", "bigint", "int"), Col("name"), Col("amount", "decimal(10,2)", "decimal", must_appear=True)),
)


def value(op=None, after=None, before=None, wrapped=False, ts_ms=0, **extra) -> str:
    body = {"op": op, "ts_ms": ts_ms, "before": before, "after": after, **extra}
    if op is None:
        body.pop("op")
    return json.dumps({"schema": {}, "payload": body} if wrapped else body)


def raw(spark: SparkSession, events, topic="shop.public.orders", partition=0) -> DataFrame:
    """``events`` are (key dict or None, value text or None), offsets follow list order."""
    rows = [
        (topic, partition, i, None, None if key is None else (key if isinstance(key, str) else json.dumps(key)), text)
        for i, (key, text) in enumerate(events)
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
