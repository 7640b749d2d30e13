"""Reduction of a change log and its application to keyed tables.

Frames here are flat: key columns, value columns, ``op`` and the position columns named by ``pos``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.clock import hybrid_time
from tideline.functions.names import parse_topic, quote
from tideline.spec import TableSpec


def position(pos: Sequence[str]) -> Column:
    return F.col(pos[0]) if len(pos) == 1 else F.struct(*[F.col(p) for p in pos])


def reduce_latest(changes: DataFrame, keys: Sequence[str], pos: Sequence[str]) -> DataFrame:
    """The last event of every key, deletes included.

    ``max_by`` aggregates on the map side, so a key holding a large share of the log sends one row
    per map task through the shuffle.
    """
    rest = [c for c in changes.columns if c not in keys]
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), position(pos)).alias("_last"))
        .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])
        .select(*changes.columns)
    )


def delete(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove keys; a key the target does not hold is no error."""
    return target.join(gone.select(*keys), list(keys), "left_anti").select(*target.columns)


def upsert(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full-row replace by key. ``rows`` must hold each key once; columns only they have are added."""
    return delete(target, rows, keys).unionByName(rows, allowMissingColumns=True)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write to shared storage and read back: computed once, safe against lost executors, and of a
    size the planner knows, so it broadcasts a small side from the start instead of first shuffling
    the large one."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, column: str, path: str) -> DataFrame:
    """The same with a folder for each value of ``column``, so that a filter on it reads only its own."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apply_reduced(
    target: DataFrame | None, latest: DataFrame, keys: Sequence[str], pos: Sequence[str], op: str = "op"
) -> DataFrame:
    """Replace and remove rows of ``target`` by changes that hold each key once."""
    live = latest.filter(F.col(op) != "d").drop(op, *[p for p in pos if p not in keys])
    if target is None:
        return live
    return delete(target, latest, keys).unionByName(live, allowMissingColumns=True)


def apply_changes(
    target: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    pos: Sequence[str],
    op: str = "op",
    staging: str | None = None,
) -> DataFrame:
    """Mirror: reduce to the last event per key, then replace and remove.

    Only the changes are shuffled to be reduced. The target meets them in one anti-join, which moves
    nothing of the target while the reduced keys are below Spark's broadcast threshold. With a large
    target give ``staging``, a path for the reduced changes: see ``stage``.
    """
    latest = reduce_latest(changes, keys, pos)
    return apply_reduced(target, stage(latest, staging) if staging else latest, keys, pos, op)


def merge_state(base: DataFrame, newer: DataFrame, keys: Sequence[str], pos: Sequence[str]) -> DataFrame:
    """Bring reduced changes into a state that still carries ``op`` and positions, deletes included.

    Either side may hold the later event of a key. Base rows whose key is not in ``newer`` pass
    through; only the touched ones are reduced again, so a small ``newer`` leaves the base unmoved.
    """
    names = newer.select(*keys)
    touched = base.join(names, list(keys), "left_semi")
    fresh = reduce_latest(touched.unionByName(newer, allowMissingColumns=True), keys, pos)
    return base.join(names, list(keys), "left_anti").unionByName(fresh, allowMissingColumns=True)


def dedup(changes: DataFrame, ids: Sequence[str] = ("topic", "partition", "offset")) -> DataFrame:
    """Drop redelivered events by their identity in the log."""
    return changes.dropDuplicates(list(ids))


def insert_if_absent(target: DataFrame, rows: DataFrame, unique: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add rows whose unique key the target lacks; among new rows with the same key the first by ``order`` wins.

    A key with a NULL part equals no other, so such rows are all added.
    """
    rest = [c for c in rows.columns if c not in unique]
    whole = F.lit(True)
    for c in unique:
        whole = whole & F.col(quote(c)).isNotNull()
    first = (
        rows.filter(whole)
        .groupBy(*unique)
        .agg(F.min_by(F.struct(*rest), position(order)).alias("_first"))
        .select(*unique, *[F.col(f"_first.{c}").alias(c) for c in rest])
    )
    fresh = first.join(target.select(*unique), list(unique), "left_anti")
    return target.unionByName(fresh.select(*target.columns)).unionByName(rows.filter(~whole).select(*target.columns))


def delete_top_k(df: DataFrame, predicate: Column, order: Sequence[Column], k: int, keys: Sequence[str]) -> DataFrame:
    """Delete the first ``k`` rows that satisfy ``predicate``, in ``order``."""
    doomed = df.filter(predicate).orderBy(*order).limit(k)
    return delete(df, doomed, keys)


def parse_signals(signals: DataFrame) -> DataFrame:
    """Signal rows ``(id, type, data)`` asking for a re-read -> ``(id, database, schema_name, table_name)``."""
    names = F.from_json("data", "`data-collections` array<string>")["data-collections"]
    asked = signals.filter(F.col("type") == "execute-snapshot").select("id", F.explode(names).alias("_name"))
    where = parse_topic(F.col("_name"))
    return asked.select(
        "id", where["prefix"].alias("database"), where["schema"].alias("schema_name"), where["table"].alias("table_name")
    )


def resnapshot(signals: DataFrame, registry: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Signals looked up in a registry of readers: ``op='r'`` rows for each table that was asked for.

    The names asked for are fetched first (at most one per registered table), so that tables nobody
    asked for are not read at all.
    """
    full = F.concat_ws(".", "schema_name", "table_name").alias("name")
    asked = parse_signals(signals).select(full).filter(F.col("name").isin(*registry)).distinct()
    return {r.name: registry[r.name]().withColumn("op", F.lit("r")) for r in asked.collect()}


def drop_overtaken(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str], inside: Column) -> DataFrame:
    """Leave out re-read rows whose key changed inside the read window: the log row is the newer one."""
    moved = changes.filter(inside).select(*keys).distinct()
    return snapshot.join(moved, list(keys), "left_anti").select(*snapshot.columns)


def apply_tables(changes: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], pos: Sequence[str]) -> dict[str, DataFrame]:
    """One mirror per table; schemas other than the default are nothing special."""
    return {name: apply_changes(None, changes[name], specs[name].keys, pos) for name in specs if name in changes}


def conditional_update(df: DataFrame, predicate: Column, sets: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """Rows hit by ``predicate`` as ``u`` changes with both images."""
    values = [c for c in df.columns if c not in keys]
    before = F.struct(*[F.col(c) for c in values])
    after = F.struct(*[sets.get(c, F.col(c)).alias(c) for c in values])
    return df.filter(predicate).select(*keys, F.lit("u").alias("op"), before.alias("before"), after.alias("after"))


def transfer(balances: DataFrame, transfers: DataFrame) -> DataFrame:
    """Apply ``(payer, payee, amount)`` rows to ``(id, balance)``; the total stays the same.

    Each transfer becomes two signed entries that are summed per account before the join. An account
    that ``balances`` lacks starts at zero and is part of the result, so no money gets lost.
    """
    net = signed_entries(transfers).groupBy("id").agg(F.sum("delta").alias("_net"))
    type_ = balances.schema["balance"].dataType
    return balances.join(net, "id", "full").select(
        "id", (F.coalesce(F.col("balance"), F.lit(0)) + F.coalesce(F.col("_net"), F.lit(0))).cast(type_).alias("balance")
    )


def signed_entries(transfers: DataFrame) -> DataFrame:
    """``(id, delta, ...)`` rows, minus for the payer and plus for the payee."""
    carried = [c for c in transfers.columns if c not in ("payer", "payee", "amount")]
    sides = F.array(
        F.struct(F.col("payer").alias("id"), (-F.col("amount")).alias("delta")),
        F.struct(F.col("payee").alias("id"), F.col("amount").alias("delta")),
    )
    return transfers.select(*carried, F.inline(sides))


def running_balance(
    changes: DataFrame, key: str, amount: str, pos: str, chunk: int = 1_000_000, out: str = "balance"
) -> DataFrame:
    """Balance of ``key`` after each change, in ``pos`` order.

    ``pos`` is an integer offset that does not repeat within a key. The log is cut into offset
    chunks: each (key, chunk) group holds at most ``chunk`` rows, so an account with a large share
    of the log is spread over many tasks. Rows are shuffled once, by (key, chunk); chunk totals are
    pre-aggregated from the key and amount columns alone and prefixed separately.
    """
    total = "decimal(38,2)"
    group = ["_key", "_chunk"]
    rows = changes.select(
        *changes.columns,
        F.struct(key).alias("_key"),
        F.coalesce(F.expr(f"{quote(pos)} div {chunk}"), F.lit(-1)).alias("_chunk"),
    )
    totals = rows.groupBy(*group).agg(F.sum(amount).cast(total).alias("_sum"))
    earlier = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*group, F.coalesce(F.sum("_sum").over(earlier), F.lit(0).cast(total)).alias("_carry"))
    inside = Window.partitionBy(*group).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_part", F.sum(amount).over(inside))
        .join(carried, group)
        .withColumn(out, (F.col("_part") + F.col("_carry")).cast("decimal(18,2)"))
        .select(*changes.columns, out)
    )


def progress(raw: DataFrame) -> DataFrame:
    """Resume position and resolved frontier of every (topic, partition).

    A mark may stand bare or inside ``payload``, as an integer or in the decimal text form of a hybrid clock. ``frontier`` is its
    whole part, ``clock`` the latest mark with its counter.
    """
    # Data rows far outnumber marks: only values that mention one are parsed.
    resolved = F.when(F.contains(F.col("value"), F.lit('"resolved"')), resolved_text("value"))
    mark = F.substring_index(resolved, ".", 1).try_cast("bigint")
    return raw.groupBy("topic", "partition").agg(
        F.max("offset").alias("max_offset"), F.max(mark).alias("frontier"), F.max(hybrid_time(resolved)).alias("clock")
    )


def resolved_text(value: str) -> Column:
    """The mark that a log value carries, as text; NULL where it is none."""
    body = F.try_parse_json(value)
    return F.coalesce(F.try_variant_get(body, "$.resolved", "string"), F.try_variant_get(body, "$.payload.resolved", "string"))
