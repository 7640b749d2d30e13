"""Change logs -> nodes and edges of a property graph.

Logs of different tables have no common order, so events are ordered by the position columns given
(event time, then topic, then offset). Each table is a flat frame: ``id``, values, ``op``, positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.apply import position, reduce_latest

POS = ("ts_ms", "topic", "offset")


def nodes(log: DataFrame, properties: Sequence[str], pos: Sequence[str] = POS) -> DataFrame:
    """Live nodes of one label: properties of the last upsert, a null property clears it."""
    last = reduce_latest(log.select("id", *properties, "op", *pos), ["id"], pos)
    return last.filter(F.col("op") != "d").select("id", *properties)


def nodes_with_placeholders(
    log: DataFrame, references: DataFrame, properties: Sequence[str], pos: Sequence[str] = POS
) -> DataFrame:
    """Live nodes of a label that another log refers to.

    ``references`` is ``(id, *pos)``, one row per referring event. A node lives when its last upsert
    or reference is later than its last delete; one known only by reference has null properties.
    Both logs meet in one aggregation, so a node referred to by much of the log costs one row per task.
    """
    own = log.select("id", position(pos).alias("_pos"), F.col("op"), F.struct(*properties).alias("_props"))
    refs = references.select("id", position(pos).alias("_pos"), F.lit("ref").alias("op"))
    both = own.unionByName(refs, allowMissingColumns=True)
    is_ref = F.col("op") == "ref"
    state = both.groupBy("id").agg(
        F.max_by(F.struct("op", "_props"), F.when(~is_ref, F.col("_pos"))).alias("_last"),
        F.max(F.when(F.col("op") == "d", F.col("_pos"))).alias("_gone"),
        F.max(F.when(is_ref, F.col("_pos"))).alias("_ref"),
    )
    alive = F.col("_last.op").isin("c", "u", "r")
    referred = F.col("_ref").isNotNull() & (F.col("_gone").isNull() | (F.col("_ref") > F.col("_gone")))
    return state.filter(F.coalesce(alive, F.lit(False)) | referred).select(
        "id",
        *[F.when(alive, F.col(f"_last._props.{p}")).alias(p) for p in properties],
        (~F.coalesce(alive, F.lit(False))).alias("placeholder"),
    )


def references(log: DataFrame, field: str, pos: Sequence[str] = POS) -> DataFrame:
    """``(id, *pos)`` of every event in ``log`` that names another node in ``field``."""
    return log.filter((F.col("op") != "d") & F.col(field).isNotNull()).select(F.col(field).alias("id"), *pos)


def _last_delete(log: DataFrame, name: str, pos: Sequence[str]) -> DataFrame:
    return log.filter(F.col("op") == "d").groupBy(F.col("id").alias(name)).agg(F.max(position(pos)).alias(f"_{name}_gone"))


def edges(
    log: DataFrame, field: str, source_log: DataFrame, mode: str = "accumulate", pos: Sequence[str] = POS
) -> DataFrame:
    """``(src, dst)`` edges from the foreign key ``field`` of ``log`` rows to their own id.

    ``accumulate``: an edge stays once made, even if the key later points elsewhere, until either end
    is deleted after it. ``current``: only the edge of the row's last event.
    """
    if mode not in ("accumulate", "current"):
        raise ValueError("mode must be 'accumulate' or 'current'")
    if mode == "current":
        last = reduce_latest(log.select("id", field, "op", *pos), ["id"], pos).filter(F.col("op") != "d")
        made = last.filter(F.col(field).isNotNull()).select(
            F.col(field).alias("src"), F.col("id").alias("dst"), position(pos).alias("_made")
        )
    else:
        made = (
            log.filter((F.col("op") != "d") & F.col(field).isNotNull())
            .groupBy(F.col(field).alias("src"), F.col("id").alias("dst"))
            .agg(F.max(position(pos)).alias("_made"))
        )
    kept = made.join(_last_delete(log, "dst", pos), "dst", "left").join(_last_delete(source_log, "src", pos), "src", "left")

    def later_than(gone: str) -> Column:
        return F.col(gone).isNull() | (F.col("_made") > F.col(gone))

    return kept.filter(later_than("_dst_gone") & later_than("_src_gone")).select("src", "dst")


def detached(all_edges: DataFrame, gone: DataFrame, end: str) -> DataFrame:
    """Edges left after the nodes in ``gone`` (``id``) are deleted at ``end`` (``src`` or ``dst``)."""
    return all_edges.join(gone.select(F.col("id").alias(end)), end, "left_anti").select(*all_edges.columns)


def degree(all_edges: DataFrame) -> DataFrame:
    return all_edges.groupBy("src").agg(F.count("*").alias("degree"))


def counts(labels: dict[str, DataFrame]) -> DataFrame:
    """``(label, n)`` for nodes and edges."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(label).alias("label"), "n") for label, df in labels.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def match(
    sources: DataFrame, all_edges: DataFrame, targets: DataFrame, source_props: Sequence[str], target_props: Sequence[str]
) -> DataFrame:
    """Rows of ``(source)-[edge]->(target)`` with the chosen properties of both ends."""
    s = sources.select(F.col("id").alias("src"), *[F.col(p).alias(f"source_{p}") for p in source_props])
    t = targets.select(F.col("id").alias("dst"), *[F.col(p).alias(f"target_{p}") for p in target_props])
    return all_edges.join(t, "dst").join(s, "src")


def numeric_property(df: DataFrame, name: str, type_: str = "double") -> DataFrame:
    return df.withColumn(name, F.col(name).try_cast(type_))
