"""Headline queries, timed warm; prints one JSON line.

The raw log is written once as files before timing, the way a log would be there to be read. Each
figure is the median of three warm runs into a sink that drops the rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import apply as A
from tideline.operators import history as H
from tideline.operators import route as R
from tideline.operators.classify import classify
from tideline.plans import catalog, flow
from tideline.plans.feeds import ORDERS, ORDERS_SPEC, Lake
from tideline.session import configure
from tideline.sources.logs import read_log
from tideline.streaming import run
from tideline.streaming.mirror import MirrorTable

RUNS = 3
POS = ["partition", "offset"]
REGISTERED = (
    "a01_reduce_composite_key",
    "a04_mirror",
    "a17_running_balance",
    "g02_edges",
    "g03_placeholder_nodes",
    "g06_pattern_match",
    "v16_row_diff",
    "w02_trailing_rate",
    "j03_outer_join_on_label",
    "q03_unique",
)


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    lake = Lake(spark, folder)
    path = lake.raw_files(16)
    log = read_log(spark, path, topics=[ORDERS])
    events = log.count()

    def mirror_from_log() -> None:
        discard(A.apply_changes(None, flow.flat_changes(log, ORDERS_SPEC), ["id"], POS))

    def history_append() -> None:
        H.append_history(R.flatten(classify(log, ORDERS_SPEC)[0], ORDERS_SPEC), lake.scratch("history"))

    def latest_view_from_log() -> None:
        flat = R.flatten(classify(log, ORDERS_SPEC)[0], ORDERS_SPEC)
        discard(H.latest_view(flat, ["id"], [F.col("__ts_ms").desc(), F.col("offset").desc()]))

    def stream_mirror() -> None:
        table = MirrorTable(lake.scratch("mirror"), ("id",), tuple(POS))
        stream = read_log(spark, path, topics=[ORDERS], streaming=True, max_files_per_trigger=8)
        run.drain(stream, lambda b, i: table.write_batch(flow.flat_changes(b, ORDERS_SPEC), i), lake.scratch("checkpoint"))
        discard(table.read(spark))

    def log_counts() -> None:
        discard(log.groupBy("topic", "partition").agg(F.count("*"), F.max("offset")))

    work = {
        "log_counts": log_counts,
        "mirror_from_log": mirror_from_log,
        "history_append": history_append,
        "latest_view_from_log": latest_view_from_log,
        "stream_mirror": stream_mirror,
        **{name: (lambda name=name: discard(catalog.QUERIES[name](spark, folder))) for name in REGISTERED},
    }
    seconds = {}
    for name, fn in work.items():
        fn()
        taken = []
        for _ in range(RUNS):
            begin = time.perf_counter()
            fn()
            taken.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(taken), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    rates = {n: round(events / seconds[n]) for n in ("mirror_from_log", "history_append", "stream_mirror")}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "log_events": events,
                "events_per_second": rates,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
