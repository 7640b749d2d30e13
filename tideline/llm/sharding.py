"""Shards by jump consistent hashing.

The shard of a row follows from its key and the number of shards alone (law ``key``): there is no ring
table, and one more shard takes rows from the others only into itself. Sizes are near equal because keys
are hashed; they are not balanced further.

Keys: an integer key is hashed as its unsigned 64-bit value, any other key as the XXH64 of its text, a
null key as zero. Rows with equal keys share a shard. Null texts have no bytes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEP = np.uint64(2862933555777941757)
ROW_OVERHEAD = 16


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Lamping and Veach's jump hash of each unsigned key; every element stops at its own number of jumps."""
    if shards < 1:
        raise ValueError("there must be a shard")
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    going = np.arange(len(state))
    reached = np.zeros(len(state), np.float64)
    with np.errstate(over="ignore"):
        while len(going):
            at[going] = reached[going].astype(np.int64)
            state[going] = state[going] * _STEP + np.uint64(1)
            reached[going] = np.floor((at[going] + 1) * (float(1 << 31) / ((state[going] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)))
            going = going[reached[going] < shards]
    return at


def _jump_column(key: Column, shards: int) -> Column:
    @F.pandas_udf(T.IntegerType())
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards), dtype="int32")

    return place(key)


def stable_key(df: DataFrame, key_col: str) -> Column:
    """A non-null 64-bit key."""
    whole = isinstance(df.schema[key_col].dataType, T.IntegralType)
    key = F.col(key_col).cast("bigint") if whole else F.xxhash64(F.col(key_col).cast("string"))
    return F.when(F.col(key_col).isNull(), F.lit(0).cast("bigint")).otherwise(key)


def shard(docs: DataFrame, shards: int, *, key_col: str = "doc_id", text_col: str = "text", rows_a_block: int = 200_000) -> DataFrame:
    """One row for each of ``docs``: its key as ``doc_id``, size, text_crc32, law, shard, slot and grown_shard.

    Slots are numbered without a gap in each shard. No shard is ordered whole: each is cut into blocks by
    a hash of the key, a block counts its own rows, and its first slot is the sum of the blocks before it.
    The number of blocks follows from the number of rows; a block of ``rows_a_block`` rows is what a task sorts.
    Slots hold as long as the set of rows does; shards hold for ever.

    An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = stable_key(docs, key_col)
    total = docs.count()
    blocks = max(1, -(-total // (rows_a_block * shards)))
    rows = docs.select(
        F.col(key_col).alias("doc_id"),
        (F.octet_length(text).cast("bigint") + ROW_OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _jump_column(key, shards).alias("shard"),
        _jump_column(key, shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"),
    )
    in_block = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")) - 1
    numbered = rows.withColumn("in_block", in_block)
    keys = docs.select(_jump_column(key, shards).alias("shard"), F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"))
    counts = keys.groupBy("shard", "block").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("shard", "block", before.alias("first_slot"))
    return numbered.join(starts, ["shard", "block"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("first_slot") + F.col("in_block")).cast("bigint").alias("slot"),
        "grown_shard",
    )
