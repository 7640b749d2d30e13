"""Declarative flows: topics -> named transforms -> tables -> sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.functions.clock import HYBRID_TIME, event_clock
from tideline.functions.names import quote, table_name
from tideline.functions.values import once
from tideline.operators import envelope, route
from tideline.operators.apply import position, stage_by
from tideline.operators.classify import action, classify, disposition, drop_tombstones, is_tombstone, quarantine_reason
from tideline.sources.logs import subscribe
from tideline.spec import FlowSpec, Step, TableSpec
from tideline.streaming import run
from tideline.streaming.mirror import MirrorTable, mirrors

# Transforms a flow may name in its configuration.
TRANSFORMS: dict[str, Callable[..., DataFrame]] = {
    "rename": route.rename_topics,
    "merge_partitions": route.merge_partitions,
    "stamp_topic": route.stamp_topic,
    "with_table": route.with_table,
    "drop_tombstones": drop_tombstones,
}


# Transforms that work out columns of a row and keep every row.
COLUMN_STEPS = (route.rename_topics, route.merge_partitions, route.stamp_topic, route.with_table)


def chain(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Apply steps in order. A step with a predicate touches only the rows that satisfy it.

    The predicate is evaluated per row, so gated steps read the input once however many there are. Only a
    step of unknown kind, which may add or drop rows, splits the input in two.
    """
    for step in steps:
        if step.predicate is None:
            df = df.transform(step.fn, **step.params)
            continue
        hit = F.coalesce(step.predicate, F.lit(False))
        if step.fn is drop_tombstones:
            df = df.filter(~hit | ~is_tombstone())
        elif step.fn in COLUMN_STEPS:
            held = df.withColumns({"_hit": hit, "_old": F.struct(*[F.col(quote(c)) for c in df.columns])})
            done = held.transform(step.fn, **step.params)
            kept = {c: F.col("_old")[c] for c in df.columns}
            df = done.select(
                *[F.when(F.col("_hit"), F.col(quote(c))).otherwise(kept.get(c, F.lit(None))).alias(c) for c in done.columns if c not in ("_hit", "_old")]
            )
        else:
            inside = df.filter(hit).transform(step.fn, **step.params)
            df = inside.unionByName(df.filter(~hit), allowMissingColumns=True)
    return df


# Types of the columns that can order events. Offsets of different topics cannot be compared, so the hybrid time of the event leads there.
POSITION_TYPES = {"clock": HYBRID_TIME, "ts_ms": "bigint", "topic": "string", "partition": "int", "offset": "bigint"}
WITHIN_A_TOPIC = ("partition", "offset")
ACROSS_TOPICS = ("clock", "topic", "partition", "offset")


def order_of(flow: FlowSpec) -> tuple[str, ...]:
    """What orders the events of a key: as declared, else by hybrid time where a step may bring several topics into one table."""
    if flow.pos:
        return tuple(flow.pos)
    merges = any(s.fn in (route.merge_partitions, route.rename_topics, route.with_table) for s in flow.transforms)
    return ACROSS_TOPICS if merges else WITHIN_A_TOPIC


def from_config(config: Mapping, tables: Mapping[str, TableSpec]) -> FlowSpec:
    """A flow from a plain dict, e.g. ``{"topics.regex": .., "transforms": ["a"], "a.type": "rename", ..}``.

    ``predicates`` map a name to a SQL condition; a transform refers to one by ``<name>.predicate``.
    """
    steps = []
    for name in config.get("transforms", ()):
        params = {k[len(name) + 1 :]: v for k, v in config.items() if k.startswith(name + ".")}
        kind = params.pop("type")
        condition = params.pop("predicate", None)
        gate = F.expr(config["predicates"][condition]) if condition else None
        steps.append(Step(name, TRANSFORMS[kind], params, gate))
    return FlowSpec(
        topics=config.get("topics", ()),
        topics_regex=config.get("topics.regex"),
        transforms=steps,
        tables=tables,
        table_template=config.get("table.name", "${topic}"),
        pos=config.get("order"),
    )


def prepared(raw: DataFrame, flow: FlowSpec, parsed: bool = False) -> DataFrame:
    """Subscribed, transformed rows with their target table in ``target``; with ``parsed`` the document of each value stays in ``_doc``."""
    rows = subscribe(raw, flow.topics or None, flow.topics_regex).withColumn("_origin", F.col("topic"))
    rows = chain(rows, flow.transforms)
    if parsed:
        rows = once(rows, _doc=F.try_parse_json("value"))
    if "target" not in rows.columns:
        doc = F.col("_doc") if parsed else None
        rows = rows.withColumn("target", table_name(F.col("topic"), flow.table_template, F.col("value"), F.col("_origin"), doc))
    return rows.drop("_origin")


def place(name: str) -> Column:
    """A position column of parsed rows; ``clock`` is worked out from the event."""
    return event_clock(F.col("event"), F.col("ts_ms")).alias(name) if name == "clock" else F.col(name)


def _flat(data: DataFrame, spec: TableSpec, pos: Sequence[str]) -> DataFrame:
    values = [n for n in spec.names if n not in spec.keys]
    return data.select(
        *[F.col("id")[k].alias(k) for k in spec.keys],
        *[F.col("after")[v].alias(v) for v in values],
        "op",
        *[place(p) for p in pos],
    )


def flat_changes(rows: DataFrame, spec: TableSpec, pos: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """Raw rows of one table -> flat changes ready to apply: key, values, ``op``, positions."""
    return _flat(classify(rows, spec)[0], spec, pos)


def decode_tables(rows: DataFrame, specs: Mapping[str, TableSpec]) -> DataFrame:
    """Raw rows with ``target``, parsed once and decoded by the spec of their own table only.

    Each table has a key, an image and its unusable columns of its own (``_id0``, ``_after0``, ``_bad0`` for the first, and so on), which are null in
    rows of other tables.
    """
    parsed = envelope.parse_envelope(rows)
    for k, name in enumerate(specs):
        parsed = envelope.decode(parsed, specs[name], only=F.col("target") == name).withColumnsRenamed({"id": f"_id{k}", "after": f"_after{k}", "bad_columns": f"_bad{k}"})
    return parsed


def of_own_table(specs: Mapping[str, TableSpec], judge: Callable[[TableSpec, Column, Column, Column], Column]) -> Column:
    """What ``judge`` says of each row of ``decode_tables`` by the spec of its table; NULL for a row of no declared table."""
    return F.coalesce(
        F.lit(None).cast("string"),
        *[F.when(F.col("target") == n, judge(specs[n], F.col(f"_id{k}"), F.col(f"_after{k}"), F.col(f"_bad{k}"))) for k, n in enumerate(specs)],
    )


def reduce_tables(rows: DataFrame, specs: Mapping[str, TableSpec], pos: Sequence[str]) -> DataFrame:
    """The last usable event of every key of every table, in one pass over ``rows`` (raw rows with ``target``).

    Keys of all tables meet in one aggregation, typed as they are: ``(target, _id0, _id1, ..)`` tells them apart.
    """
    decoded = decode_tables(rows.filter(F.col("target").isin(*specs)), specs)
    usable = decoded.filter(of_own_table(specs, disposition).isin("upsert", "delete"))
    ids, images = ([f"_{side}{k}" for k in range(len(specs))] for side in ("id", "after"))
    placed = usable.select("target", *ids, *images, "op", *[place(p).alias(f"_pos{i}") for i, p in enumerate(pos)])
    where = [f"_pos{i}" for i in range(len(pos))]
    # the table's name comes out of the aggregation, so that a filter on it stays above and all tables share what is below
    last = F.max_by(F.struct(F.col("target").alias("table"), "op", *images, *where), position(where))
    return placed.groupBy("target", *ids).agg(last.alias("_last")).select("_last.*", *ids)


def sorted_out(rows: DataFrame, specs: Mapping[str, TableSpec], pos: Sequence[str], declared: Sequence[str] | None = None) -> DataFrame:
    """Rows of a batch that go anywhere, decoded: usable events of each table, and with a ``reason`` those for its quarantine.

    ``reason`` is ``unknown_table`` where ``target`` is not ``declared``, which are the tables of ``specs`` unless given. Only rows with a reason carry their key and value on, so what is
    kept of a batch is small beside its text.
    """
    known = F.coalesce(F.col("target").isin(*(specs if declared is None else declared)), F.lit(False))
    decoded = decode_tables(rows, specs) if specs else rows.withColumn("op", F.lit(None).cast("string"))
    lost = F.when(~known & ~is_tombstone(), F.lit("unknown_table"))
    judged = once(decoded, reason=lost)
    for k, name in enumerate(specs):  # a step for each table: generated code that is too long stays uncompiled
        why = quarantine_reason(specs[name], F.col(f"_id{k}"), F.col(f"_after{k}"), F.col(f"_bad{k}"))
        judged = once(judged, **{f"_why{k}": F.when(F.col("target") == name, why)})
    judged = judged.withColumn("reason", F.coalesce("reason", *[f"_why{k}" for k in range(len(specs))]))
    usable = of_own_table(specs, lambda spec, key, after, bad: action(F.col("op"), after)).isin("upsert", "delete")
    return judged.filter(F.col("reason").isNotNull() | usable).select(
        "target", "reason", "topic", "partition", "offset", "op",
        *[F.when(F.col("reason").isNotNull(), F.col(c)).alias(c) for c in ("key", "value")],
        *[f"_{side}{k}" for k in range(len(specs)) for side in ("id", "after")],
        *[place(p).alias(f"_pos{i}") for i, p in enumerate(pos) if specs],
    )


def _flat_of(rows: DataFrame, specs: Mapping[str, TableSpec], pos: Sequence[str], name: str) -> DataFrame:
    """Key, values, ``op`` and positions of the rows of one table."""
    k, spec = list(specs).index(name), specs[name]
    return rows.select(
        *[F.col(f"_id{k}")[c].alias(c) for c in spec.keys],
        *[F.col(f"_after{k}")[c].alias(c) for c in spec.names if c not in spec.keys],
        "op",
        *[F.col(f"_pos{i}").alias(p) for i, p in enumerate(pos)],
    )


def latest_of(reduced: DataFrame, specs: Mapping[str, TableSpec], pos: Sequence[str], name: str) -> DataFrame:
    """One table of ``reduce_tables``: key, values, ``op``, positions; deletes included."""
    return _flat_of(reduced.filter(F.col("table") == name), specs, pos, name)


def apply_tables_once(
    rows: DataFrame, specs: Mapping[str, TableSpec], pos: Sequence[str], staging: str | None = None, at_once: int = 16
) -> dict[str, DataFrame]:
    """Mirror of every table from raw rows with ``target``, read once for up to ``at_once`` tables.

    Frames used in one query share the pass by themselves. With ``staging`` the reduced events are written there, a folder for each table,
    so that queries run one after the other share it too.
    """
    out, names = {}, list(specs)
    for first in range(0, len(names), at_once):
        some = {n: specs[n] for n in names[first : first + at_once]}
        reduced = reduce_tables(rows, some, pos)
        if staging:
            reduced = stage_by(reduced, "table", f"{staging}/{first}")
        for name in some:
            live = latest_of(reduced, some, pos, name).filter(F.col("op") != "d")
            out[name] = live.select(*some[name].keys, *[c for c in some[name].names if c not in some[name].keys])
    return out


def run_batch(raw: DataFrame, flow: FlowSpec, pos: Sequence[str] | None = None, staging: str | None = None) -> dict[str, DataFrame]:
    """Mirror of every declared table from a whole log, which is read and parsed once; see ``apply_tables_once``."""
    out = apply_tables_once(prepared(raw, flow), flow.tables, pos or order_of(flow), staging)
    for name, mirror in out.items():
        for sink in flow.sinks:
            sink(name, mirror)
    return out


def run_stream(
    stream: DataFrame, flow: FlowSpec, root: str, every: str | None = None, at_once: int = 16
) -> tuple[StreamingQuery, dict[str, MirrorTable]]:
    """The same flow on a stream, feeding mirror tables under ``root``. A batch is parsed once for up to ``at_once`` tables.

    Events that cannot be used go to ``root/_quarantine/<table>`` with their reason, and the stream
    goes on. Those of a table that is not declared, or whose table cannot be told, go to
    ``root/_quarantine/_unknown_table``. Returns the started query and the mirror tables; with ``every`` unset it drains and stops.
    """
    pos = {c: POSITION_TYPES[c] for c in order_of(flow)}
    tables = mirrors(root, flow.tables, pos)
    shown = ("topic", "partition", "offset", "key", "value", "reason")

    def handler(name: str, specs: Mapping[str, TableSpec]) -> run.OnBatch:
        keep = run.per_batch_folder(quarantine_path(root, name))

        def on_batch(rows: DataFrame, batch_id: int) -> None:
            tables[name].write_batch(_flat_of(rows.filter(F.col("reason").isNull()), specs, tuple(pos), name), batch_id)
            keep(rows.filter(F.col("reason").isNotNull()).select(*shown), batch_id)

        return on_batch

    keep_unknown = run.per_batch_folder(quarantine_path(root, UNKNOWN_TABLE))

    def undeclared(rows: DataFrame, batch_id: int) -> None:
        keep_unknown(rows.filter(F.col("reason") == "unknown_table").select(*shown), batch_id)

    names = list(flow.tables)
    groups = [{n: flow.tables[n] for n in names[first : first + at_once]} for first in range(0, len(names) or 1, at_once)]

    def splitter(specs: Mapping[str, TableSpec], others: run.OnBatch | None) -> run.OnBatch:
        split = run.each_table({n: handler(n, specs) for n in specs}, "target", others)

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            mine = batch if others else batch.filter(F.col("target").isin(*specs))
            split(sorted_out(mine, specs, tuple(pos), names), batch_id)

        return on_batch

    hooks = [splitter(specs, undeclared if specs is groups[0] else None) for specs in groups]
    if flow.on_batch:
        hooks.append(lambda batch, batch_id: flow.on_batch(batch.drop("_doc"), batch_id))
    query = run.start(prepared(stream, flow, parsed=bool(names)), run.tee(hooks), f"{root}/_checkpoint", every)
    return query, tables


UNKNOWN_TABLE = "_unknown_table"


def unknown_rows(raw: DataFrame, flow: FlowSpec) -> DataFrame:
    """Rows of a log that ``run_batch`` has no declared table for, with a reason."""
    rows = prepared(raw, flow)
    known = F.coalesce(F.col("target").isin(*flow.tables), F.lit(False))
    return rows.filter(~known & ~is_tombstone()).withColumn("reason", F.lit("unknown_table"))


def quarantine_path(root: str, table: str) -> str:
    return f"{root}/_quarantine/{table}"
