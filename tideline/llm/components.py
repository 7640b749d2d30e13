"""Connected components of a graph given as a table of edges.

Large-star and small-star steps (Kiveris et al., 2014) alternate until nothing changes: every step is a
grouped minimum and a join, the number of rounds grows with the logarithm of the longest chain, and a hub
is pre-aggregated before the shuffle. Each round is a stored table, so a lost executor repeats one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stored


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node with an edge; root is the smallest node of its component.

    ``edges`` has two columns of one orderable type; direction, repeats and loops do not matter. Rows
    with a null end are ignored. No edges give no rows.
    """
    a, b = edges.columns
    both = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = stored(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = _mark(now)
    while before[0]:
        either = now.union(now.select("v", "u"))
        lowest = either.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every greater neighbour of u hangs on the least node around u
        large = either.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every lesser neighbour of u, and u, hang on the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = stored(small.where("u <> v").distinct(), "edges")
        after = _mark(now)
        if after == before:
            break
        before = after
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
