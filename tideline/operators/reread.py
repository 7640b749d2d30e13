"""Tables read again in key chunks beside the running log (the published low and high mark method).

Before a chunk is read a low mark is written to the log, after it a high mark. A row read in between is as new as the log at some point
between the marks: it replaces whatever the log said before the low mark, loses to any change of its key between the
marks, and to all later ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.apply import parse_signals

OPEN, CLOSE = "snapshot-window-open", "snapshot-window-close"


def windows(marks: DataFrame, pos: str = "offset") -> DataFrame:
    """``(chunk, low, high)`` from marks ``(chunk, type, pos)``. A chunk read several times has the window of its last close; one that
    was opened and not closed since has none, and its rows wait."""
    closed = F.max(F.when(F.col("type") == CLOSE, F.col(pos)))
    opened = F.max(F.when(F.col("type") == OPEN, F.col(pos)))
    found = marks.groupBy("chunk").agg(opened.alias("low"), closed.alias("high"))
    return found.filter(F.col("low") < F.col("high"))


def placed(
    reread: DataFrame, changes: DataFrame, marks: DataFrame, keys: Sequence[str], chunk: Column, pos: str = "offset", op: str = "op"
) -> DataFrame:
    """Rows of ``reread`` that stand, as ``r`` changes at the position of their chunk's high mark, ready to be joined to ``changes``.

    ``chunk`` is an expression over the key columns. Only changes inside a window are moved to be compared, by key; the windows are one
    row for each chunk, and Spark chooses how they meet the rows by their size.
    """
    spans = windows(marks, pos)
    names = [c for c in reread.columns if c not in (op, pos)]
    rows = reread.select(*names, chunk.alias("chunk")).join(spans, "chunk")
    inside = changes.select(*keys, F.col(pos).alias("_pos"), chunk.alias("chunk")).join(spans, "chunk")
    moved = inside.filter((F.col("_pos") > F.col("low")) & (F.col("_pos") < F.col("high"))).select(*keys).distinct()
    kept = rows.join(moved, list(keys), "left_anti")
    return kept.select(*names, F.lit("r").alias(op), F.col("high").alias(pos))


def with_rereads(
    changes: DataFrame, reread: DataFrame, marks: DataFrame, keys: Sequence[str], chunk: Column, pos: str = "offset", op: str = "op"
) -> DataFrame:
    """The log with the standing re-read rows at their places: reducing it gives the state, keeping it the history."""
    rows = placed(reread, changes, marks, keys, chunk, pos, op)
    return changes.unionByName(rows.select(*[F.col(c).cast(changes.schema[c].dataType).alias(c) for c in changes.columns]))


def requests(signals: DataFrame, registered: Sequence[str]) -> DataFrame:
    """``(id, name, known)`` of every table asked for, also of those that nobody registered."""
    name = F.concat_ws(".", "schema_name", "table_name")
    return parse_signals(signals).select("id", name.alias("name"), name.isin(*registered).alias("known"))
