"""Audits of the constraints a table declares: each returns the violating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.values import month_range
from tideline.operators.verify import union
from tideline.spec import TableSpec


def check_violations(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the CHECK is false; an unknown (null) result passes."""
    return df.filter(~F.expr(condition))


def null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count; keys with a null part never collide."""
    known = df
    for c in columns:
        known = known.filter(F.col(c).isNotNull())
    return known.groupBy(*columns).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def fk_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    known = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti").select(*child.columns)


def range_violations(df: DataFrame, column: str, partition: str, prefix: str) -> DataFrame:
    """Rows outside the half-open month that their partition name ``<prefix>YYYY_MM`` stands for."""
    month = F.to_date(F.substring(F.col(partition), F.lit(len(prefix) + 1), F.lit(7)), "yyyy_MM")
    bounds = month_range(month)
    day = F.col(column).cast("timestamp_ntz")
    return df.filter(
        ~((day >= bounds["lower"].cast("timestamp_ntz")) & (day < bounds["upper"].cast("timestamp_ntz")))
    )


def length_violations(df: DataFrame, column: str, limit: int) -> DataFrame:
    return df.filter(F.length(column) > limit)


def audit(df: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All declared constraints of a table: ``(rule, key, value)`` per violation.

    Row-level rules share one pass over the table; unique and foreign keys add one shuffle each.
    """
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in spec.keys])
    marks = []
    for name, condition in spec.checks.items():
        marks.append(F.when(~F.expr(condition), F.struct(F.lit(f"check:{name}").alias("rule"), F.lit(condition).alias("value"))))
    for c in spec.columns:
        if not c.nullable:
            marks.append(F.when(F.col(c.name).isNull(), F.struct(F.lit(f"not_null:{c.name}").alias("rule"), F.lit("").alias("value"))))
        if c.length is not None:
            marks.append(
                F.when(
                    F.length(c.name) > c.length,
                    F.struct(F.lit(f"length:{c.name}").alias("rule"), F.length(c.name).cast("string").alias("value")),
                )
            )
    parts = []
    if marks:
        rows = df.select(key.alias("key"), F.explode(F.array_compact(F.array(*marks))).alias("_m"))
        parts.append(rows.select("_m.rule", "key", "_m.value"))
    for columns in (spec.keys, *spec.unique):
        rule = "unique:" + ",".join(columns)
        text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
        parts.append(
            unique_violations(df, columns).select(
                F.lit(rule).alias("rule"), text.alias("key"), F.col("n").cast("string").alias("value")
            )
        )
    for fk in spec.fks:
        parent = (parents or {})[fk.parent]
        parts.append(
            fk_violations(df, fk.column, parent, fk.parent_column).select(
                F.lit(f"fk:{fk.column}").alias("rule"), key.alias("key"), F.col(fk.column).cast("string").alias("value")
            )
        )
    return union(parts)
