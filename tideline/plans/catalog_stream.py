"""Streaming queries (ST): each runs until its input is drained and returns the table it fed.

The whole log is the input, as several files, so a run takes several micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators import classify as C
from tideline.operators import envelope as E
from tideline.operators import graph as G
from tideline.operators import metrics as M
from tideline.operators import verify as V
from tideline.operators.apply import apply_changes, progress, resolved_text
from tideline.plans import flow
from tideline.plans.catalog_graph import CUSTOMER_PROPS, graph_sql
from tideline.plans.catalog_state import _RATE, changes, metric_samples
from tideline.plans.feeds import CUSTOMERS, CUSTOMERS_SPEC, ORDERS, ORDERS_SPEC, PARTITIONS, Lake, metric_sql, order_sql, pruned, shop_sql, wire_sql
from tideline.plans.registry import query
from tideline.sources.logs import read_log
from tideline.spec import FlowSpec
from tideline.streaming import run
from tideline.streaming.bucketed import BucketedMirror
from tideline.streaming.frontier import FrontierRelease
from tideline.streaming.mirror import MirrorTable, mirrors
from tideline.streaming.seen import SeenOffsets

POS = ("partition", "offset")
BATCHES_A_BASE = 64_000  # bytes of pending changes: small, so that a base is made at any scale


def order_stream(lake: Lake, files: int = 6, per_batch: int = 2) -> DataFrame:
    return read_log(lake.spark, lake.raw_files(files), topics=[ORDERS], streaming=True, max_files_per_trigger=per_batch)


def order_mirror(lake: Lake) -> MirrorTable:
    return mirrors(lake.scratch("mirror"), {"orders": ORDERS_SPEC}, {"partition": "int", "offset": "bigint"})["orders"]


def feed(table: MirrorTable) -> run.OnBatch:
    return lambda batch, batch_id: table.write_batch(flow.flat_changes(batch, ORDERS_SPEC, POS), batch_id)


@query("st01_continuous_apply", order_sql("SELECT id, customer_id, amount, status FROM mirror"))
def continuous_apply(lake: Lake) -> DataFrame:
    table = order_mirror(lake)
    run.drain(order_stream(lake), feed(table), lake.scratch("checkpoint"))
    return table.read(lake.spark)


_SLICED = """
, sl AS (SELECT *, id % 4 AS p, CASE WHEN y >= 1998 THEN 3 WHEN y >= 1996 THEN 2 WHEN y >= 1994 THEN 1 ELSE 0 END AS slice
  FROM (SELECT *, year(make_timestamp((ts_ms + id % 1000) * 1000)) AS y FROM wire)),
k AS (SELECT unnest([0, 1, 2, 3]) AS slice),
m AS (SELECT k.slice, p, max(ts_ms) AS mark FROM sl JOIN k ON sl.slice <= k.slice WHERE kind = 9 GROUP BY 1, 2),
fr AS (SELECT slice, CASE WHEN count(*) = 4 THEN min(mark) END AS frontier FROM m GROUP BY 1),
rel AS (SELECT sl.op, sl.ts_ms, sl.slice, (SELECT min(fr.slice) FROM fr WHERE fr.slice >= sl.slice AND sl.ts_ms <= fr.frontier) AS batch
  FROM sl WHERE kind IN (0, 1, 2, 3, 5))"""


def sliced_release(lake: Lake) -> tuple[FrontierRelease, DataFrame, int]:
    """The order log in slices, each handed to the same stream as one batch after a restart; rows are released at the frontier."""
    log, checkpoint = lake.scratch("slices"), lake.scratch("checkpoint")
    release = FrontierRelease(lake.scratch("release"), partitions={ORDERS: PARTITIONS})

    def decoded(batch: DataFrame) -> DataFrame:
        return C.classify(batch, ORDERS_SPEC)[0].select("topic", "partition", "offset", "op", "ts_ms")

    for k in range(lake.slices()):
        lake.order_slice(k).write.mode("append").parquet(log)
        run.drain(read_log(lake.spark, log, streaming=True), lambda b, i: release.write_batch(b, decoded(b), i), checkpoint)
    return release, decoded(read_log(lake.spark, log)), lake.slices() - 1


@query("st01_bucketed_apply", order_sql("SELECT id, customer_id, amount, status FROM mirror"))
def bucketed_apply(lake: Lake) -> DataFrame:
    """The same stream into a bucketed mirror, which compacts itself on the way."""
    columns = {c.name: c.type for c in ORDERS_SPEC.columns} | {"op": "string", "partition": "int", "offset": "bigint"}
    table = BucketedMirror(lake.scratch("bucketed"), ("id",), POS, columns, buckets=8, compact_bytes=BATCHES_A_BASE)
    run.drain(order_stream(lake), lambda batch, i: table.write_batch(flow.flat_changes(batch, ORDERS_SPEC, POS), i), lake.scratch("checkpoint"))
    return table.read(lake.spark)


@query(
    "st02_resolved_frontier",
    wire_sql(_SLICED.lstrip("\n") + """
SELECT coalesce(batch, -1) AS batch, op, batch > slice AS waited, count(*) AS n FROM (SELECT batch, op, CASE WHEN batch IS NOT NULL THEN slice END AS slice FROM rel)
GROUP BY 1, 2, 3"""),
)
def resolved_frontier(lake: Lake) -> DataFrame:
    """Rows released in each batch, at once or after waiting; batch -1 are those still held at the end."""
    release, rows, last = sliced_release(lake)
    released = run.read_batches(lake.spark, f"{release.path}/released").join(
        release.held(lake.spark, rows, last + 1).select("partition", "offset", "topic", F.lit(True).alias("was_held")).distinct(), ["topic", "partition", "offset"], "left"
    )
    done = released.groupBy(F.col("batch_id").cast("int").alias("batch"), "op", F.coalesce("was_held", F.lit(False)).alias("waited")).agg(F.count("*").alias("n"))
    held = release.waiting(lake.spark, rows, last).groupBy(F.lit(-1).alias("batch"), "op", F.lit(None).cast("boolean").alias("waited")).agg(F.count("*").alias("n"))
    return done.unionByName(held)


@query(
    "st03_heartbeat_progress",
    wire_sql("""
SELECT CAST(id % 4 AS INTEGER) AS "partition", max(ts_ms) AS frontier, count(*) AS heartbeats,
  CAST(max(ts_ms) AS DECIMAL(30,10)) + CASE WHEN id % 4 = 1 THEN CAST('0.0000000003' AS DECIMAL(30,10)) ELSE 0 END AS clock FROM wire WHERE kind = 9 GROUP BY id % 4"""),
)
def heartbeat_progress(lake: Lake) -> DataFrame:
    """Marks of every form count: bare or wrapped, number or text, with a key or without."""
    kept = lake.scratch("progress")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        beats = batch.filter(F.contains(F.col("value"), F.lit('"resolved"'))).filter(resolved_text("value").isNotNull())
        seen = beats.groupBy("topic", "partition").agg(F.count("*").alias("heartbeats"))
        run.per_batch_folder(kept)(progress(beats).join(seen, ["topic", "partition"]), batch_id)

    run.drain(order_stream(lake), on_batch, lake.scratch("checkpoint"))
    rows = run.read_batches(lake.spark, kept)
    return rows.groupBy("partition").agg(F.max("frontier").alias("frontier"), F.sum("heartbeats").alias("heartbeats"), F.max("clock").alias("clock"))


@query(
    "st04_restart_resumes",
    wire_sql("SELECT 'first' AS run, count(*) AS input_rows FROM wire UNION ALL SELECT 'second', 0"),
)
def restart_resumes(lake: Lake) -> DataFrame:
    """The same query started again on its checkpoint reads nothing it has read before."""
    seen, checkpoint = lake.scratch("seen"), lake.scratch("checkpoint")
    keep = run.per_batch_folder(seen)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        keep(batch.agg(F.count("*").alias("n")), batch_id)

    run.drain(order_stream(lake), on_batch, checkpoint)
    last = run.read_batches(lake.spark, seen).agg(F.max("batch_id")).head()[0]
    run.drain(order_stream(lake), on_batch, checkpoint)
    rows = run.read_batches(lake.spark, seen)
    first, second = F.col("batch_id") <= last, F.col("batch_id") > last
    both = rows.agg(
        F.coalesce(F.sum(F.when(first, F.col("n"))), F.lit(0)).alias("a"), F.coalesce(F.sum(F.when(second, F.col("n"))), F.lit(0)).alias("b")
    )
    pair = F.array(
        F.struct(F.lit("first").alias("run"), F.col("a").alias("input_rows")), F.struct(F.lit("second").alias("run"), F.col("b").alias("input_rows"))
    )
    return both.select(F.inline(pair))


@query("st05_effectively_once", order_sql("SELECT id, customer_id, amount, status FROM mirror"))
def effectively_once(lake: Lake) -> DataFrame:
    """Every batch is delivered twice, and once more as a later batch after a compaction."""
    table = order_mirror(lake)
    write = feed(table)
    run.drain(order_stream(lake), run.tee([write, write]), lake.scratch("checkpoint"))
    table.compact(lake.spark)
    run.drain(order_stream(lake, per_batch=6), lambda b, i: write(b, i + 1000), lake.scratch("checkpoint"))
    return table.read(lake.spark)


@query("st06_commit_interval", order_sql("SELECT count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM mirror"))
def commit_interval(lake: Lake) -> DataFrame:
    """A continuous run that commits at an interval, stopped once the log is consumed."""
    table = order_mirror(lake)
    running = run.start(order_stream(lake, per_batch=3), feed(table), lake.scratch("checkpoint"), every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return table.read(lake.spark).agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount"))


@query("st07_order_within_partition", order_sql("SELECT id, customer_id, amount, status FROM mirror"))
def order_within_partition(lake: Lake) -> DataFrame:
    """Files that hold each key's events in no useful order still end in the same state."""
    path = lake.scratch("mixed")
    files = lake.files_for(lake.order_rows(), 5)
    lake.write_log(lake.order_raw().repartition(files, F.xxhash64("value", "offset")), path)
    table = order_mirror(lake)
    stream = read_log(lake.spark, path, streaming=True, max_files_per_trigger=1)
    run.drain(stream, feed(table), lake.scratch("checkpoint"))
    return table.read(lake.spark)


@query("st08_late_parent", graph_sql("SELECT id, name, segment, balance, placeholder FROM cnode"))
def late_parent(lake: Lake) -> DataFrame:
    """Orders are streamed before any customer; their customers start as bare nodes."""
    root = lake.scratch("graph")
    for topic in (ORDERS, CUSTOMERS):
        spec = ORDERS_SPEC if topic == ORDERS else CUSTOMERS_SPEC
        pos = ("topic", "partition", "offset", "ts_ms")
        stream = read_log(lake.spark, lake.raw_files(), topics=[topic], streaming=True, max_files_per_trigger=3)
        keep = run.per_batch_folder(f"{root}/{topic}")
        run.drain(stream, lambda b, i, keep=keep, spec=spec, pos=pos: keep(flow.flat_changes(b, spec, pos), i), lake.scratch("checkpoint"))
    refs = G.references(run.read_batches(lake.spark, f"{root}/{ORDERS}"), "customer_id")
    people = run.read_batches(lake.spark, f"{root}/{CUSTOMERS}")
    return G.nodes_with_placeholders(people, refs, CUSTOMER_PROPS)


@query(
    "st09_hop_throughput",
    metric_sql(_RATE + """
SELECT replace(name, '_total', '') AS name, date_trunc('minute', ts) AS window_start, CAST(sum(increase) AS DECIMAL(18,2)) AS increase,
  CAST(CAST(sum(increase) AS DECIMAL(18,2)) AS DOUBLE) / 60.0 AS per_second FROM i GROUP BY 1, 2"""),
)
def hop_throughput(lake: Lake) -> DataFrame:
    rates = M.hop_rates(metric_samples(lake))
    return rates.select(
        "name", F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("increase").cast("decimal(18,2)").alias("increase"), "per_second"
    )


@query(
    "st10_lag",
    wire_sql("SELECT 'shop.public.orders' AS topic, max(id % 1000) AS ms_behind_source FROM wire WHERE op IS NOT NULL"),
)
def source_lag(lake: Lake) -> DataFrame:
    """Per batch: how far the newest handled event was behind; the report keeps the worst batch."""
    kept = lake.scratch("lag")
    keep = run.per_batch_folder(kept)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        rows = E.parse_envelope(batch).filter(C.has_op()).withColumn("seen_ms", F.unix_millis("ts"))
        keep(M.lag(rows, ["topic"], "ts_ms", "seen_ms"), batch_id)

    run.drain(order_stream(lake), on_batch, lake.scratch("checkpoint"))
    return run.read_batches(lake.spark, kept).groupBy("topic").agg(F.max("ms_behind_source").alias("ms_behind_source"))


@query(
    "st11_running_counters",
    wire_sql("""
SELECT 'shop.public.orders' AS topic, count(*) AS total, count(*) FILTER (WHERE op = 'c') AS creates, count(*) FILTER (WHERE op = 'u') AS updates,
  count(*) FILTER (WHERE op = 'd') AS deletes FROM wire WHERE op IS NOT NULL"""),
)
def running_counters(lake: Lake) -> DataFrame:
    """A stateful aggregate in complete mode; its table is rewritten by every batch."""
    kept = lake.scratch("counters")
    counted = M.op_counters(E.parse_envelope(order_stream(lake)).filter(C.has_op()), ["topic"])
    run.drain(counted, run.rewrite_folder(kept), lake.scratch("checkpoint"), mode="complete")
    return lake.spark.read.parquet(kept)


@query(
    "st12_snapshot_flags",
    metric_sql("""
SELECT event_id, CASE WHEN value = 1 THEN 'yes' ELSE 'no' END AS running, CASE WHEN value = 1 THEN 'yes' ELSE 'no (resumed/streaming)' END AS completed
FROM metric WHERE name = 'capture_metrics_SnapshotRunning'"""),
)
def snapshot_flags(lake: Lake) -> DataFrame:
    flags = metric_samples(lake).filter((F.col("name") == "capture_metrics_SnapshotRunning") & (F.col("labels")["context"] == "snapshot"))
    return flags.select(
        "event_id",
        M.flag_label(F.col("value"), M.SNAPSHOT_RUNNING).alias("running"),
        M.flag_label(F.col("value"), M.SNAPSHOT_COMPLETED).alias("completed"),
    )


@query(
    "st13_schema_change",
    "SELECT event_id, event_type = 'view' AS lacked_field, CASE WHEN event_type NOT IN ('view', 'click') THEN 'app' END AS channel FROM events",
)
def schema_change(lake: Lake) -> DataFrame:
    """Events with and without a new field pass through one running stream; old rows hold null in it."""
    from tideline.plans.feeds import WIDE_SPEC

    path = lake.scratch("wide")
    late = F.get_json_object("value", "$.after.channel").isNotNull()
    rows = lake.wide_raw()
    rows.repartitionByRange(lake.files_for(rows, 4), late, "offset").write.parquet(path)
    spec = pruned(WIDE_SPEC, "channel")
    kept = lake.scratch("evolved")
    keep = run.per_batch_folder(kept)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        rows = E.decode(E.parse_envelope(batch), spec)
        keep(rows.select("id.event_id", E.is_absent("after", "channel").alias("lacked_field"), "after.channel"), batch_id)

    run.drain(read_log(lake.spark, path, streaming=True, max_files_per_trigger=1), on_batch, lake.scratch("checkpoint"))
    return run.read_batches(lake.spark, kept).drop("batch_id")


@query(
    "st14_drain_and_compare",
    shop_sql("""
SELECT 'orders' AS table_name, count(*) || '|' || CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS VARCHAR) AS source,
  count(*) || '|' || CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS VARCHAR) AS target, true AS equal FROM mirror"""),
)
def drain_and_compare(lake: Lake) -> DataFrame:
    declared = FlowSpec(topics=(ORDERS,), tables={"orders": ORDERS_SPEC}, table_template="${source.table}")
    stream = read_log(lake.spark, lake.raw_files(), streaming=True, max_files_per_trigger=2)
    running, tables = flow.run_stream(stream, declared, lake.scratch("flow"))
    running.awaitTermination()
    expected = apply_changes(None, changes(lake), ["id"], ["offset"])
    return V.parity({"orders": expected}, {"orders": tables["orders"].read(lake.spark)}, "amount")


@query("st15_redelivery_dedup", order_sql("SELECT op, count(*) AS n FROM (SELECT DISTINCT seq, op FROM ch) GROUP BY op"))
def redelivery_dedup(lake: Lake) -> DataFrame:
    """Repeats of a log position are dropped on the way in, by the offset ranges seen so far; what is kept is read without an exchange."""
    seen = SeenOffsets(lake.scratch("unique"), compact_after=2)
    run.drain(order_stream(lake), seen.write_batch, lake.scratch("checkpoint"))
    data = C.classify(seen.read(lake.spark).drop("batch_id"), ORDERS_SPEC)[0]
    return data.groupBy("op").agg(F.count("*").alias("n"))


@query(
    "st15_seen_offsets",
    wire_sql(_SLICED.lstrip("\n") + """
SELECT k.slice AS batch, count(seq) AS arrived, count(*) FILTER (WHERE rn = 1) AS kept
FROM k LEFT JOIN (SELECT slice, seq, row_number() OVER (PARTITION BY seq ORDER BY slice) AS rn FROM sl) r ON r.slice = k.slice
GROUP BY 1 UNION ALL SELECT 4, count(*), 0 FROM sl WHERE slice = 1"""),
)
def seen_offsets(lake: Lake) -> DataFrame:
    """The log in slices of years, each after a restart, and at the end the slice of 1994 and 1995 again, years late."""
    log, checkpoint, arrived = lake.scratch("slices"), lake.scratch("checkpoint"), lake.scratch("arrived")
    seen = SeenOffsets(lake.scratch("unique"), compact_after=2)
    keep = run.per_batch_folder(arrived)

    def count(batch: DataFrame, batch_id: int) -> None:
        keep(batch.agg(F.count("*").alias("arrived")), batch_id)

    for k in [*range(lake.slices()), 1]:
        lake.order_slice(k).write.mode("append").parquet(log)
        run.drain(read_log(lake.spark, log, streaming=True), run.tee([seen.write_batch, count]), checkpoint)
    kept = seen.read(lake.spark).groupBy("batch_id").agg(F.count("*").alias("kept"))
    both = run.read_batches(lake.spark, arrived).join(kept, "batch_id", "left")
    return both.select(F.col("batch_id").cast("int").alias("batch"), "arrived", F.coalesce("kept", F.lit(0)).alias("kept"))


@query(
    "f05_stream_goes_on",
    wire_sql("""
SELECT 'applied' AS part, '' AS reason, count(*) AS n FROM mirror
UNION ALL SELECT 'quarantine', CASE kind WHEN 6 THEN 'unparsable' WHEN 7 THEN 'no_key' WHEN 8 THEN 'unknown_op' ELSE 'bad_value:amount' END, count(*)
FROM wire WHERE kind IN (6, 7, 8, 10, 12) GROUP BY 2"""),
)
def stream_goes_on(lake: Lake) -> DataFrame:
    """Bad events end up in quarantine with a reason; the rest of their batch is applied."""
    declared = FlowSpec(topics=(ORDERS,), tables={"orders": ORDERS_SPEC}, table_template="${source.table}")
    root = lake.scratch("flow")
    stream = read_log(lake.spark, lake.raw_files(), streaming=True, max_files_per_trigger=3)
    running, tables = flow.run_stream(stream, declared, root)
    running.awaitTermination()
    applied = tables["orders"].read(lake.spark).agg(F.count("*").alias("n")).select(F.lit("applied").alias("part"), F.lit("").alias("reason"), "n")
    bad = run.read_batches(lake.spark, flow.quarantine_path(root, "orders")).groupBy("reason").agg(F.count("*").alias("n"))
    return applied.unionByName(bad.select(F.lit("quarantine").alias("part"), "reason", "n"))


@query(
    "st01_many_tables",
    shop_sql("SELECT 'orders' AS table_name, count(*) AS n FROM mirror UNION ALL SELECT 'customers', count(*) FROM cmirror"),
)
def many_tables(lake: Lake) -> DataFrame:
    """One stream feeding two mirrors, each batch decoded once per table and cached between them."""
    specs = {"orders": ORDERS_SPEC, "customers": CUSTOMERS_SPEC}
    declared = FlowSpec(topics=(ORDERS, CUSTOMERS), tables=specs, table_template="${source.table}")
    stream = read_log(lake.spark, lake.raw_files(), streaming=True, max_files_per_trigger=3)
    running, tables = flow.run_stream(stream, declared, lake.scratch("flow"))
    running.awaitTermination()
    return V.table_counts({n: t.read(lake.spark) for n, t in tables.items()})


@query(
    "st01_batch_rows",
    wire_sql("""
SELECT count(*) AS n FROM (SELECT DISTINCT id FROM ch)"""),
)
def distinct_keys_written(lake: Lake) -> DataFrame:
    """A whole log in one batch writes one row per key."""
    table = order_mirror(lake)
    run.drain(order_stream(lake, per_batch=100), feed(table), lake.scratch("checkpoint"))
    return table.changes(lake.spark).agg(F.count("*").alias("n"))
