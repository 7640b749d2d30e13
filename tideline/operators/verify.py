"""Proof that a target holds what its source holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.values import money_text


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def fingerprint(df: DataFrame, amount: str | None = None, name: str = "fingerprint") -> DataFrame:
    """``count`` or ``count|sum`` as one text value; the sum has a fixed two-digit form."""
    parts = [F.count("*").cast("string")]
    if amount:
        parts.append(money_text(F.coalesce(F.sum(amount), F.lit(0))))
    return df.agg(F.concat_ws("|", *parts).alias(name))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n)`` for every table."""
    return union(
        [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    )


def joined_counts(counts: DataFrame, order: Sequence[str]) -> DataFrame:
    """The counts in the given table order as one ``a|b|c`` text; a table that is missing shows as ``?``."""
    values = [F.coalesce(F.max(F.when(F.col("table_name") == t, F.col("n"))).cast("string"), F.lit("?")) for t in order]
    return counts.agg(F.concat_ws("|", *values).alias("fingerprint"))


def parity(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame], amount: str | None = None) -> DataFrame:
    """``(table_name, source, target, equal)`` fingerprints; a missing table is unequal, not ignored."""
    rows = []
    for side, tables in (("source", source), ("target", target)):
        for name, df in tables.items():
            rows.append(fingerprint(df, amount).select(F.lit(name).alias("table_name"), F.lit(side).alias("side"), "fingerprint"))
    both = union(rows)
    pick = {s: F.max(F.when(F.col("side") == s, F.col("fingerprint"))).alias(s) for s in ("source", "target")}
    return (
        both.groupBy("table_name")
        .agg(*pick.values())
        .withColumn("equal", F.coalesce(F.col("source") == F.col("target"), F.lit(False)))
    )


def op_histogram(df: DataFrame, op: str = "__op") -> DataFrame:
    return df.groupBy(op).agg(F.count("*").alias("n"))


def count_where(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, sorted by range partitions rather than inside one group."""
    return df.select(column).distinct().orderBy(column)


def expectations(df: DataFrame, rules: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """``rule -> (aggregate, test over it)``, all in one pass: rows ``(rule, found, ok)``."""
    aggregates = df.agg(*[agg.cast("string").alias(name) for name, (agg, _) in rules.items()])
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("found"), F.coalesce(test, F.lit(False)).alias("ok"))
        for name, (_, test) in rules.items()
    ]
    return aggregates.select(F.inline(F.array(*rows)))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def missing_names(found: DataFrame, expected: DataFrame, name: str) -> DataFrame:
    """Expected names that were not found; found names are made distinct before they are shuffled."""
    return expected.select(name).distinct().join(found.select(name).distinct(), name, "left_anti")


def partition_distribution(df: DataFrame, part: str) -> DataFrame:
    return df.groupBy(part).agg(F.count("*").alias("n"))


def has_exact(df: DataFrame, column: str, value: str, type_: str) -> DataFrame:
    """Is this exact decimal present? Compared as a decimal, never as text or float."""
    hits = F.count_if(F.col(column) == F.lit(value).cast(type_))
    return df.agg(hits.alias("hits"), (hits > 0).alias("present"))


def conservation(versions: DataFrame, version: str, amount: str) -> DataFrame:
    """One row: smallest and largest per-version total and whether they agree."""
    totals = versions.groupBy(version).agg(F.sum(amount).cast("decimal(18,2)").alias("_total"))
    return totals.agg(
        F.count("*").alias("versions"),
        F.min("_total").alias("lowest"),
        F.max("_total").alias("highest"),
        (F.min("_total") == F.max("_total")).alias("conserved"),
    )


def numeric_text_sum(df: DataFrame, column: str) -> DataFrame:
    """Sum and count over the numeric entries of a text column; other entries are left out."""
    digits = F.col(column).rlike("^[0-9]+$")
    return df.agg(
        F.coalesce(F.sum(F.when(digits, F.col(column).try_cast("bigint"))), F.lit(0)).alias("total"),
        F.count_if(digits).alias("numeric_rows"),
    )


def within(before: DataFrame, after: DataFrame, slack: int) -> DataFrame:
    """One-value frames compared: did ``after`` grow by no more than ``slack``?"""
    b, a = (df.toDF(name) for df, name in ((before, "before"), (after, "after")))
    return b.select("before", a.select("after").scalar().alias("after")).withColumn(
        "ok", F.col("after") <= F.col("before") + slack
    )


def assert_value(df: DataFrame, expected: object) -> None:
    """Fail unless the one-value frame holds ``expected``."""
    found = df.head()[0]
    if found != expected:
        raise AssertionError(f"expected {expected!r}, found {found!r}")


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """Hash of the row that tells a null from a value moved to a neighbouring column."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def row_diff(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, difference)`` for every key that is missing, extra or changed in the target.

    Both sides are hashed and meet in one aggregation instead of a full outer join, so a repeated key
    is pre-aggregated and neither side is moved whole.
    """
    columns = [c for c in source.columns if c not in keys]

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keys, row_hash(df, columns).cast("decimal(38,0)").alias("_h"), F.lit(sign).alias("_side"))

    both = side(source, 1).unionByName(side(target, -1))
    per_key = both.groupBy(*keys).agg(
        F.count_if(F.col("_side") == 1).alias("_s"),
        F.count_if(F.col("_side") == -1).alias("_t"),
        F.sum(F.col("_h") * F.col("_side")).alias("_delta"),
    )
    kind = (
        F.when(F.col("_t") == 0, F.lit("missing"))
        .when(F.col("_s") == 0, F.lit("extra"))
        .when((F.col("_s") != F.col("_t")) | (F.col("_delta") != 0), F.lit("changed"))
    )
    return per_key.withColumn("difference", kind).filter("difference IS NOT NULL").select(*keys, "difference")


def slice_sums(df: DataFrame, keys: Sequence[str], columns: Sequence[str], slices: int) -> DataFrame:
    """``(slice, n, total)``: rows and the sum of row hashes of each slice of the keys. Summed on the map side, so at most ``slices`` rows leave a task."""
    slice_ = F.pmod(F.xxhash64(*keys), F.lit(slices)).alias("slice")
    return df.select(slice_, row_hash(df, [*keys, *columns]).cast("decimal(38,0)").alias("_h")).groupBy("slice").agg(F.count("*").alias("n"), F.sum("_h").alias("total"))


def differing_slices(source: DataFrame, target: DataFrame, keys: Sequence[str], slices: int = 4096) -> DataFrame:
    """``(slice, source_rows, target_rows)`` of the key slices whose sums differ."""
    columns = [c for c in source.columns if c not in keys]

    def side(df: DataFrame, sign: int) -> DataFrame:
        sums = slice_sums(df, keys, columns, slices)
        return sums.select("slice", "n", (F.col("total") * sign).alias("total"), F.lit(sign).alias("_side"))

    both = side(source, 1).unionByName(side(target, -1)).groupBy("slice")
    found = both.agg(
        F.coalesce(F.sum(F.when(F.col("_side") == 1, F.col("n"))), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum(F.when(F.col("_side") == -1, F.col("n"))), F.lit(0)).alias("target_rows"),
        F.sum("total").alias("_delta"),
    )
    return found.filter((F.col("source_rows") != F.col("target_rows")) | (F.col("_delta") != 0)).drop("_delta")


def row_diff_by_slice(source: DataFrame, target: DataFrame, keys: Sequence[str], slices: int = 4096) -> DataFrame:
    """``row_diff`` in two levels: sums of key slices first, then only rows of slices that differ.

    Equal tables shuffle slice sums and no row. The numbers of differing slices, at most ``slices``, come to the driver. Both sides are
    read twice: stage one that is dear to work out. With few differences among many keys choose ``slices`` well above their number.
    """
    differ = [r["slice"] for r in differing_slices(source, target, keys, slices).select("slice").collect()]

    def some(df: DataFrame) -> DataFrame:
        if len(differ) == slices:
            return df
        return df.filter(F.pmod(F.xxhash64(*keys), F.lit(slices)).isin(*differ) if differ else F.lit(False))

    return row_diff(some(source), some(target), keys)
