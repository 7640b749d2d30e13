"""Small value helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A filter on an ordinary computed column is pushed below it and repeats its whole expression. A
    one-element ``inline`` keeps costly parsing in one place; it stays inside generated code.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def money_text(value: Column, type_: str = "decimal(18,2)") -> Column:
    """Fixed two-digit text, the same in every engine."""
    return value.cast(type_).cast("string")


def stable_uuid(*parts: Column) -> Column:
    """A UUID-shaped identifier that depends only on its inputs (a random one would differ on retry)."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])


def pick(values: list[str], index: Column) -> Column:
    """1-based pick from a short literal list; NULL outside it."""
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def month_range(month: Column) -> Column:
    """Half-open [first day, first day of next month) for a date inside the month."""
    start = F.trunc(month, "month")
    return F.struct(start.alias("lower"), F.add_months(start, 1).alias("upper"))
