"""Which rows are data, control or unusable, and the predicates used on the way."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.names import full_match
from tideline.operators.envelope import decode, parse_envelope
from tideline.spec import TableSpec

# Operation codes that carry an after image, and the one that removes a row.
UPSERT_OPS = ("c", "u", "r")
DELETE_OP = "d"


def is_tombstone(value: str | Column = "value") -> Column:
    col = F.col(value) if isinstance(value, str) else value
    return col.isNull() | (F.btrim(col, F.lit(" \t\n\r\f\v")) == "")


def drop_tombstones(raw: DataFrame) -> DataFrame:
    return raw.filter(~is_tombstone())


def has_op(op: str | Column = "op") -> Column:
    col = F.col(op) if isinstance(op, str) else op
    return col.isNotNull() & (col != "")


def action(op: Column, after: Column) -> Column:
    """``delete``, ``upsert`` or ``skip`` for a recognised operation; NULL for an unknown one."""
    return (
        F.when(op == DELETE_OP, F.lit("delete"))
        .when(op.isin(*UPSERT_OPS) & after.isNotNull(), F.lit("upsert"))
        .when(op.isin(*UPSERT_OPS), F.lit("skip"))
    )


def quarantine_reason(spec: TableSpec, key: Column, after: Column, bad: Column) -> Column:
    """Why a decoded row cannot be used; NULL where it can, or is no data."""
    no_key = F.lit(False)
    for k in spec.keys:
        no_key = no_key | key[k].isNull()
    act = action(F.col("op"), after)
    return (
        F.when(F.col("event").isNull(), F.when(~is_tombstone(), F.lit("unparsable")))
        .when(~has_op(), None)
        .when(no_key, F.lit("no_key"))
        .when(act.isNull(), F.lit("unknown_op"))
        .when((act == "upsert") & (bad != ""), F.concat(F.lit("bad_value:"), bad))
    )


def _kind(reason: Column, after: Column) -> Column:
    return (
        F.when(F.col("event").isNull() & is_tombstone(), F.lit("tombstone"))  # a tombstone never parses: the text of other rows is not looked at
        .when(reason.isNotNull(), F.lit("quarantine"))
        .when(~has_op(), F.lit("control"))
        .otherwise(action(F.col("op"), after))
    )


def disposition(spec: TableSpec, key: Column, after: Column, bad: Column) -> Column:
    """What is to be done with a row of ``spec`` decoded into these columns; see ``with_disposition``."""
    return _kind(quarantine_reason(spec, key, after, bad), after)


def with_disposition(raw: DataFrame, spec: TableSpec, before: bool = False) -> DataFrame:
    """Decode raw rows of one table and add ``disposition`` and, for quarantined rows, ``reason``.

    Dispositions: tombstone, control, delete, upsert, skip, quarantine. Nothing raises: one bad
    event costs one quarantine row and the rest of the batch goes on.
    """
    rows = decode(parse_envelope(raw), spec, before)
    reason = quarantine_reason(spec, F.col("id"), F.col("after"), F.col("bad_columns"))
    return rows.withColumn("reason", reason).withColumn("disposition", _kind(F.col("reason"), F.col("after"))).drop("bad_columns")


def classify(raw: DataFrame, spec: TableSpec, before: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(data, control, quarantine). Data holds upserts and deletes only."""
    rows = with_disposition(raw, spec, before)
    return (
        rows.filter(F.col("disposition").isin("upsert", "delete")).drop("reason"),
        rows.filter(F.col("disposition") == "control").drop("reason"),
        rows.filter(F.col("disposition") == "quarantine"),
    )


def exclude_tables(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep control tables (``schema.table``) away from data sinks."""
    return df.filter(~F.concat_ws(".", "schema_name", "table_name").isin(*names))


def include_tables(df: DataFrame, names: Sequence[str] = (), regexes: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose ``schema.table`` is listed or wholly matches a pattern."""
    full = F.concat_ws(".", "schema_name", "table_name")
    keep = full.isin(*names) if names else F.lit(False)
    for pattern in regexes:
        keep = keep | full_match(full, pattern)
    return df.filter(keep)


def where_equals(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def like(column: Column, pattern: str, ignore_case: bool = False, negate: bool = False) -> Column:
    hit = column.ilike(pattern) if ignore_case else column.like(pattern)
    return ~hit if negate else hit


def only_ops(df: DataFrame, ops: Sequence[str]) -> DataFrame:
    return df.filter(F.col("op").isin(*ops))


def has_field(column: str, side: str = "after") -> Column:
    """The parsed image carries this field, null or not."""
    return F.try_variant_get("event", f"$.{side}.{column}", "variant").isNotNull()


def severe_lines(df: DataFrame, line: str, pattern: str, benign: str, order: Sequence[str], keep: int) -> DataFrame:
    """Log lines matching ``pattern`` but not ``benign``; the last ``keep`` by ``order``."""
    return (
        df.filter(F.col(line).rlike(pattern) & ~F.col(line).rlike(benign))
        .orderBy(*[F.col(c).desc() for c in order])
        .limit(keep)
    )
