"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

usage: check_oracle.py [folder] [name-prefix ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

import duckdb
from pyspark.sql import SparkSession

from tideline.session import configure

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v: object) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    return str(v)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, fn, sql: str | None, folder: str) -> str:
    df = fn(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows-only {len(got)}"
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    want = rows_of(cols, res.fetchall())
    if sorted(cols) != sorted(df.columns):
        return f"MISMATCH columns {sorted(df.columns)} / {sorted(cols)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        lacking = [r for r in want if r not in set(got)][:3]
        return f"MISMATCH {len(got)} / {len(want)} rows; only spark {extra}; only sql {lacking}"
    return f"ok {len(got)}"


def main() -> None:
    from tideline.plans import catalog

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = (
        configure(SparkSession.builder.master("local[8]"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    bad = 0
    for name, fn in catalog.QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        begin = time.time()
        try:
            result = compare(spark, con, fn, catalog.ORACLES.get(name), folder)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            result = f"ERROR {type(error).__name__} {str(error)[:600]}"
        if not result.startswith(("ok", "rows-only")) or result in ("ok 0", "rows-only 0"):
            bad += 1
            print(f"{name:32s} {time.time() - begin:6.2f}s {result}", flush=True)
        elif wanted:
            print(f"{name:32s} {time.time() - begin:6.2f}s {result}", flush=True)
    print(f"{bad} to look at")


if __name__ == "__main__":
    main()
