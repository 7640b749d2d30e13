"""Metric samples from text lines, counter rates, lag and connector tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.values import once


@dataclass(frozen=True)
class MetricRule:
    """A pattern, the series name and labels built from its groups, and a fixed value if the
    attribute is text. ``@domain`` and ``@series`` stand for the exporter's own names."""

    pattern: str
    name: str
    labels: Mapping[str, str] = field(default_factory=dict)
    value: float | None = None


# Attribute lines a Kafka Connect worker exports, in matching order (first match wins).
CONNECT_RULES = (
    MetricRule("kafka.connect<type=connect-worker-metrics>([^:]+):", "kafka_connect_worker_metrics_$1"),
    MetricRule(
        "kafka.connect<type=connect-metrics, client-id=([^:]+)><>([^:]+)", "kafka_connect_metrics_$2", {"client": "$1"}
    ),
    *[
        MetricRule(
            f"kafka.connect<type=connector-metrics, connector=(.+)><>{attribute}: (.+)",
            f"kafka_connect_connector_{label}",
            {"connector": "$1", label: "$2"},
            1.0,
        )
        for attribute, label in (
            ("connector-version", "version"),
            ("connector-class", "class"),
            ("connector-type", "type"),
            ("status", "status"),
        )
    ],
    *[
        MetricRule(
            f"kafka.connect<type={side}-task-metrics, connector=(.+), task=(.+)><>{side}-record-{verb}-total",
            f"kafka_connect_{side}_record_{verb}_total",
            {"connector": "$1", "task": "$2"},
        )
        for side, verb in (("source", "write"), ("source", "poll"), ("sink", "read"), ("sink", "send"))
    ],
)

# Attribute lines of the change-capture engine itself, in matching order.
CAPTURE_RULES = (
    MetricRule(
        "@domain.([^:]+)<type=connector-metrics, context=([^,]+), server=([^,]+), key=([^>]+)><>RowsScanned",
        "@series_RowsScanned",
        {"plugin": "$1", "name": "$3", "context": "$2", "table": "$4"},
    ),
    MetricRule(
        "@domain.([^:]+)<type=connector-metrics, server=([^,]+), task=([^,]+), context=([^,]+), database=([^>]+)>([^:]+)",
        "@series_$6",
        {"plugin": "$1", "name": "$2", "task": "$3", "context": "$4", "database": "$5"},
    ),
    MetricRule(
        "@domain.([^:]+)<type=connector-metrics, server=([^,]+), task=([^,]+), context=([^>]+)>([^:]+)",
        "@series_$5",
        {"plugin": "$1", "name": "$2", "task": "$3", "context": "$4"},
    ),
    MetricRule(
        "@domain.([^:]+)<type=connector-metrics, context=([^,]+), server=([^>]+)>([^:]+)",
        "@series_$4",
        {"plugin": "$1", "name": "$3", "context": "$2"},
    ),
)

# Sides and verbs of the record counters, in the order a record passes them.
HOP_COUNTERS = (("source", "poll"), ("source", "write"), ("sink", "read"), ("sink", "send"))
HOPS = {f"kafka_connect_{side}_record_{verb}": f"{side} {verb}" for side, verb in HOP_COUNTERS}

# Labels of the snapshot flags.
SNAPSHOT_RUNNING = {0: "no", 1: "yes"}
SNAPSHOT_COMPLETED = {0: "no (resumed/streaming)", 1: "yes"}


def rules_for(domain: str, series: str) -> tuple[MetricRule, ...]:
    """All rules with the engine's exporter domain and series prefix filled in."""
    filled = [
        MetricRule(r.pattern.replace("@domain", domain), r.name.replace("@series", series), r.labels, r.value)
        for r in CAPTURE_RULES
    ]
    return (*CONNECT_RULES, *filled)


def _template(line: Column, pattern: str, text: str) -> Column:
    parts = [
        F.regexp_extract(line, pattern, int(p[1:])) if re.fullmatch(r"\$\d+", p) else F.lit(p)
        for p in re.split(r"(\$\d+)", text)
        if p
    ]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _required_text(pattern: str) -> str:
    """Literal text every match contains, or empty where that cannot be told simply.

    Only plain characters outside groups and character classes count, and no pattern with alternatives, optional parts or escapes.
    """
    if re.search(r"[|?*{\\]", pattern):
        return ""
    runs, depth, at = [""], 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "[":  # a class: one character of several, up to its closing bracket
            at = pattern.find("]", at + (3 if pattern[at + 1 : at + 2] == "^" else 2))
            if at < 0:
                return ""
        depth += (c == "(") - (c == ")")
        if depth or c in ".()[]^$+":
            runs.append("")
        else:
            runs[-1] += c
        at += 1
    return max(runs, key=len)


def _matches(line: Column, rule: MetricRule) -> Column:
    """Regex test behind a plain substring test, which settles most lines cheaply."""
    text = _required_text(rule.pattern)
    hit = line.rlike(rule.pattern)
    return line.contains(text) & hit if text else hit


def _sample(line: Column, rule: MetricRule) -> Column:
    pairs = [x for k, v in rule.labels.items() for x in (F.lit(k), _template(line, rule.pattern, v))]
    labels = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    value = F.lit(rule.value) if rule.value is not None else F.regexp_extract(line, r":\s*([^:\s]+)\s*$", 1).try_cast("double")
    name = F.regexp_replace(_template(line, rule.pattern, rule.name), "[^a-zA-Z0-9:]+|_+", "_")
    return F.struct(name.alias("name"), labels.alias("labels"), value.cast("double").alias("value"))


def extract_metrics(lines: DataFrame, line: str, rules: Sequence[MetricRule]) -> DataFrame:
    """Text lines -> ``(name, labels, value)`` beside the other columns; lines no rule matches are dropped."""
    text = F.col(line)
    found = F.coalesce(*[F.when(_matches(text, r), _sample(text, r)) for r in rules])
    kept = [c for c in lines.columns if c != line]
    return once(lines, _m=found).filter("_m IS NOT NULL").select(*kept, "_m.name", "_m.labels", "_m.value")


def without_total(name: Column) -> Column:
    """Series name without a trailing ``_total``: writers and readers differ on it."""
    return F.regexp_replace(name, "_total$", "")


def counter_increase(
    samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value", chunk_seconds: int = 3600
) -> DataFrame:
    """Adds ``increase`` since the series' previous sample; a drop is a restart, so it counts in full.

    The first sample of a series has no increase. Each series is cut into time chunks: only a chunk is
    ordered inside one task, and the last sample of the chunk before is carried over from a
    pre-aggregated chunk table, so a series with a large share of the samples is spread out.
    A series has one sample per instant: a repeated one keeps the larger value. Samples without a
    time are left out, as they have no place in the order.

    Samples are shuffled once, by (series, chunk), and both branches read that shuffle. The series is
    held as one struct, so a label that is null identifies a series like any other value.
    """
    group = ["_series", "_chunk"]
    placed = (
        samples.filter(F.col(ts).isNotNull())
        .select(
            F.struct(*series).alias("_series"),
            F.coalesce(F.floor(F.unix_seconds(F.col(ts)) / F.lit(chunk_seconds)), F.lit(-1)).alias("_chunk"),
            ts,
            value,
        )
        .repartition(*group)
    )
    rows = placed.groupBy(*group, ts).agg(F.max(value).alias(value))
    lasts = placed.groupBy(*group).agg(F.max_by(value, F.struct(ts, value)).alias("_end"))
    carry = lasts.withColumn("_carry", F.lag("_end").over(Window.partitionBy("_series").orderBy("_chunk"))).drop("_end")
    before = F.lag(value).over(Window.partitionBy(*group).orderBy(ts))
    change = F.when(F.col(value) >= F.col("_prev"), F.col(value) - F.col("_prev")).otherwise(F.col(value))
    return (
        rows.withColumn("_inside", before)
        .join(carry, group)
        .withColumn("_prev", F.coalesce("_inside", "_carry"))
        .select("_series.*", ts, value, F.when(F.col("_prev").isNotNull(), change).alias("increase"))
    )


def windowed_rate(increases: DataFrame, by: Sequence[str], ts: str = "ts", width: str = "1 minute") -> DataFrame:
    """Per tumbling window and group: summed increase and records per second of the window's own length."""
    total = F.sum("increase")
    window = F.window(F.col(ts), width)
    return (
        increases.filter("increase IS NOT NULL")
        .groupBy(*by, window.alias("_window"))
        .agg(total.alias("increase"))
        .select(
            *by,
            F.col("_window.start").alias("window_start"),
            "increase",
            (F.col("increase").cast("double") / ((F.unix_micros("_window.end") - F.unix_micros("_window.start")) / 1e6)).alias("per_second"),
        )
    )


def trailing_rate(increases: DataFrame, by: Sequence[str], ts: str = "ts", seconds: int = 60, chunk_seconds: int = 3600) -> DataFrame:
    """At each instant of a group: increase and records per second of the ``seconds`` up to and including it.

    A group is cut into time chunks, and rows of the last ``seconds`` of a chunk are also given to the next one, where
    they only count for others. No group is ordered whole inside one task.
    """
    if seconds > chunk_seconds:
        raise ValueError("the trailing span must fit into a chunk")
    micros, span, chunk = F.unix_micros(F.col(ts)), seconds * 1_000_000, chunk_seconds * 1_000_000
    own = F.floor(micros / F.lit(chunk))
    last = F.floor((micros + F.lit(span - 1)) / F.lit(chunk))
    instants = increases.filter(F.col("increase").isNotNull() & F.col(ts).isNotNull()).groupBy(*by, ts).agg(F.sum("increase").alias("_step"))
    placed = instants.select(*by, ts, "_step", micros.alias("_us"), own.alias("_own"), F.explode(F.sequence(own, last)).alias("_chunk"))
    before = Window.partitionBy(*by, "_chunk").orderBy("_us").rangeBetween(1 - span, 0)
    total = placed.withColumn("increase", F.sum("_step").over(before)).filter("_own = _chunk")
    return total.select(*by, ts, "increase", (F.col("increase").cast("double") / F.lit(float(seconds))).alias("per_second"))


def hop_rates(samples: DataFrame, ts: str = "ts") -> DataFrame:
    """Records per second at each hop, all connectors and tasks summed."""
    series = samples.select(
        without_total(F.col("name")).alias("name"),
        F.col("labels")["connector"].alias("connector"),
        F.col("labels")["task"].alias("task"),
        ts,
        "value",
    ).filter(F.col("name").isin(*HOPS))
    rates = windowed_rate(counter_increase(series, ["name", "connector", "task"], ts), ["name"], ts)
    label = F.create_map(*[F.lit(x) for pair in HOPS.items() for x in pair])
    return rates.withColumn("hop", label[F.col("name")])


def lag(events: DataFrame, by: Sequence[str], event_ms: str, processed_ms: str) -> DataFrame:
    """Largest milliseconds behind the source per group (a batch, a topic)."""
    return events.groupBy(*by).agg(F.max(F.col(processed_ms) - F.col(event_ms)).alias("ms_behind_source"))


def op_counters(events: DataFrame, by: Sequence[str] = (), op: str = "op") -> DataFrame:
    """Events seen: total, create, update and delete."""
    return events.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(F.col(op) == "c").alias("creates"),
        F.count_if(F.col(op) == "u").alias("updates"),
        F.count_if(F.col(op) == "d").alias("deletes"),
    )


def flag_label(value: Column, labels: Mapping[int, str]) -> Column:
    """0/1 flag as its label; other values stay null."""
    out = F.lit(None).cast("string")
    for number, text in labels.items():
        out = F.when(value == number, F.lit(text)).otherwise(out)
    return out


def connector_table(samples: DataFrame, fields: Sequence[str], join_on: str = "connector", ts: str = "ts") -> DataFrame:
    """The newest ``kafka_connect_connector_<field>`` label of every field, outer-joined on one label.

    All series come from one scan and meet in one aggregation; a connector lacking a field keeps its
    row with a null there, as an N-way full outer join would give.
    """
    names = {f: f"kafka_connect_connector_{f}" for f in fields}
    rows = samples.filter(F.col("name").isin(*names.values())).withColumn("_on", F.col("labels")[join_on])
    newest = [
        F.max_by(F.col("labels")[f], F.when(F.col("name") == n, F.col(ts))).alias(f) for f, n in names.items()
    ]
    return rows.groupBy(F.col("_on").alias(join_on)).agg(*newest)
