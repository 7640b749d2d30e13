"""Projection, renaming, merging and routing of change rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.names import full_match, rename, table_name
from tideline.spec import TableSpec


def flatten(changes: DataFrame, spec: TableSpec, add: Sequence[str] = ("op", "ts_ms"), deletes: str = "rewrite") -> DataFrame:
    """Decoded changes -> one flat row per event: image columns plus ``__op``, ``__ts_ms``, ``__deleted``.

    ``rewrite`` keeps a delete as a row flagged ``'true'`` (a string) whose key columns are filled and
    whose other columns come from the before image when there is one; ``drop`` leaves deletes out.
    """
    if deletes not in ("rewrite", "drop"):
        raise ValueError("deletes must be 'rewrite' or 'drop'")
    rows = changes if deletes == "rewrite" else changes.filter(F.col("op") != "d")
    has_before = "before" in changes.columns
    gone = F.col("op") == "d"

    def field(name: str) -> Column:
        kept = F.col("after")[name]
        if name in spec.keys:
            return F.when(gone, F.col("id")[name]).otherwise(F.coalesce(kept, F.col("id")[name]))
        old = F.col("before")[name] if has_before else F.lit(None)
        return F.when(gone, old).otherwise(kept)

    carried = [c for c in ("topic", "partition", "offset") if c in changes.columns]
    return rows.select(
        *[field(n).alias(n) for n in spec.names],
        *[F.col(a).alias(f"__{a}") for a in add],
        F.when(gone, F.lit("true")).otherwise(F.lit("false")).alias("__deleted"),
        *carried,
    )


def rename_topics(df: DataFrame, pattern: str, replacement: str, column: str = "topic") -> DataFrame:
    return df.withColumn(column, rename(F.col(column), pattern, replacement))


def merge_partitions(
    df: DataFrame, pattern: str, target: str, key_field: str | None = None, column: str = "topic"
) -> DataFrame:
    """Send every topic of a partitioned table to one logical topic.

    With ``key_field`` the physical topic is kept beside the row, for sources whose keys are unique
    only within one partition; without it the record key stays as it is.
    """
    out = df.withColumn(key_field, F.col(column)) if key_field else df
    return rename_topics(out, pattern, target, column)


def stamp_topic(df: DataFrame, field: str = "_topic") -> DataFrame:
    return df.withColumn(field, F.col("topic"))


def route(df: DataFrame, field: str, routes: Mapping[str, str]) -> dict[str, DataFrame]:
    """One frame per table whose pattern wholly matches ``field``; a row may go to none or to several."""
    return {table: df.filter(full_match(F.col(field), pattern)) for table, pattern in routes.items()}


def route_tags(df: DataFrame, field: str, routes: Mapping[str, str], out: str = "route") -> DataFrame:
    """The same routing in one pass: a row per (event, matching table)."""
    hits = F.array(*[F.when(full_match(F.col(field), p), F.lit(t)) for t, p in routes.items()])
    return df.withColumn(out, F.explode(F.array_compact(hits)))


def with_table(df: DataFrame, template: str = "${topic}", out: str = "target") -> DataFrame:
    return df.withColumn(out, table_name(F.col("topic"), template, F.col("value") if "value" in df.columns else None))


def key_columns(spec: TableSpec, requested: Iterable[str] = ()) -> list[str]:
    """Requested key fields that this table really has; its whole key when nothing is requested."""
    wanted = list(requested)
    if not wanted:
        return list(spec.keys)
    chosen = [k for k in wanted if k in spec.keys]
    if not chosen:
        raise ValueError(f"none of {wanted} is a key column of {spec.name}")
    return chosen


def images(changes: DataFrame) -> DataFrame:
    """Updates with both images side by side."""
    return changes.filter(F.col("op") == "u").select("topic", "partition", "offset", "id", "before", "after")


def fan_out(batch: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """Write one batch through several sinks, computing it once."""
    held = batch.persist()
    try:
        for sink in sinks:
            sink(held)
    finally:
        held.unpersist()


def fan_in_rows(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Many topics through one renaming, the new name in ``target``."""
    return df.withColumn("target", rename(F.col("topic"), pattern, replacement))


def fan_in(df: DataFrame, specs: Mapping[str, TableSpec], pattern: str, replacement: str) -> dict[str, DataFrame]:
    """The rows of each target table that has a spec; one pass for all tables is ``plans.flow.apply_tables_once``."""
    named = fan_in_rows(df, pattern, replacement)
    return {target: named.filter(F.col("target") == target) for target in specs}


def display(changes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Operation and the first of ``fields`` the after image carries, as text, empty when none does."""
    picks = [F.try_variant_get("event", f"$.after.{f}", "string") for f in fields]
    return changes.select("topic", "partition", "offset", "op", F.coalesce(*picks, F.lit("")).alias("name"))


def rename_columns(df: DataFrame, mapping: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in order])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
