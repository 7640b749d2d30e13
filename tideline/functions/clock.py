"""Hybrid logical time: a wall clock in nanoseconds and a counter for events of the same instant.

On the wire it is decimal text, ``<nanoseconds>.<ten digits of counter>``, or plain nanoseconds. As one exact decimal it orders events
of different topics, which offsets cannot.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions.decode import decimal_from_text

HYBRID_TIME = "decimal(30,10)"
# Where an envelope may carry its time, the most exact first.
CLOCK_PATHS = ("$.source.ts_hlc", "$.updated", "$.ts_ns", "$.source.ts_ns")


def hybrid_time(text: Column) -> Column:
    """(wall, counter) as one decimal; NULL where the text is no such time or has more digits than it may."""
    return decimal_from_text(text, HYBRID_TIME)


def event_clock(event: Column, ts_ms: Column) -> Column:
    """The hybrid time of a parsed envelope; one that has only milliseconds counts as the start of its millisecond."""
    found = [hybrid_time(F.try_variant_get(event, path, "string")) for path in CLOCK_PATHS]
    return F.coalesce(*found, (ts_ms.cast("decimal(19,0)") * 1_000_000).cast(HYBRID_TIME))
