"""Helpers shared by the corpus operators.

A document set is any frame with an id column and a text column; further columns are carried along
or left out, never looked at. Names of working columns are made fresh, so they cannot clash.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tideline.session import scratch_path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def pick(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, so that extra columns are neither read nor in the way."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table under the folder all executors share, and read back.

    Lineage ends there: a lost executor costs a re-read, not a re-run of what lies before. The shuffle files of
    the run are given back when the table is written, rather than whenever the driver's memory is next cleaned.
    """
    return written(df, name)[0]


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stored`` and the path of the table, for ``emptied``."""
    path = scratch_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def emptied(spark: SparkSession, path: str) -> None:
    """Gives back the space of the table at ``path``, a path of ``written``, once nothing that is still to run reads it."""
    spark.range(0, 0, 1, 1).write.mode("overwrite").parquet(path)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """A text column as UTF-8 bytes, without decoding."""
    return column.cast(pa.large_binary()).to_pylist()


def groups(texts: list[bytes | None], most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def tidied(run: Callable) -> Callable:
    """``run`` over the batches of a task, after which the worker gives back the memory it no longer needs: other stages use it later."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not every C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return whole


def with_columns(
    df: DataFrame,
    inputs: list[str],
    start: Callable[[], Callable[..., Iterable[pa.Array | list]]],
    fields: T.StructType,
) -> DataFrame:
    """``df`` with ``fields`` appended, worked out from the columns ``inputs`` one Arrow batch at a time.

    ``start()`` runs once for each task and returns the function of a batch. Rows are neither moved nor shuffled.
    """
    schema = T.StructType([*df.schema.fields, *fields.fields])
    places = [df.columns.index(c) for c in inputs]
    kinds = to_arrow_schema(fields)
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            made = work(*(batch.column(i) for i in places))
            new = [x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return df.mapInArrow(tidied(run), schema)


def keep_rows(df: DataFrame, inputs: list[str], start: Callable[[], Callable[..., list[bool]]]) -> DataFrame:
    """Rows of ``df`` for which the function made by ``start()`` says True; all columns stay as they are."""
    places = [df.columns.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            yield batch.filter(pa.array(work(*(batch.column(i) for i in places)), pa.bool_()))

    return df.mapInArrow(tidied(run), df.schema)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


class Vocabulary:
    """Numbers for words as a task meets them, and what has been worked out for each word.

    ``trim`` forgets everything once there are more than ``most`` words, so memory stays bounded; call it between batches.
    """

    def __init__(self, most: int = 250_000):
        self.most, self.words, self.done = most, [], None
        self.number = _Numbers(self.words)

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def scored(self, score: Callable[[list[bytes]], np.ndarray]) -> np.ndarray:
        """``score`` of all words so far, one row each; only new words are worked out."""
        have = 0 if self.done is None else len(self.done)
        if self.done is None or have < len(self.words):
            new = score(self.words[have:])
            self.done = new if self.done is None else np.concatenate([self.done, new])
        return self.done

    def trim(self) -> None:
        if len(self.words) > self.most:
            self.__init__(self.most)


class _Numbers(dict):
    def __init__(self, words: list[bytes]):
        self.words = words

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        return n


def split_hot(rows: DataFrame, keys: list[str], member: list[str], most: int, sizes: DataFrame) -> DataFrame:
    """``rows`` with ``c`` and ``d``: the pair of chunks of a hot bucket in which a row is looked at.

    ``sizes`` (keys, bucket_n) needs to list buckets of more than ``most`` rows only. Such a bucket is cut into chunks by a hash of
    ``member``; every two chunks, and each with itself, meet under one (keys, c, d), so that each pair of
    rows meets and no (keys, c, d) has much more than twice ``most`` rows. Other buckets have the one chunk pair (0, 0).
    """
    counted = rows.join(sizes.select(*keys, "bucket_n"), keys, "left")
    chunks = F.coalesce(F.ceil(F.col("bucket_n") / most).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64(*member), chunks).cast("int")
    spread = counted.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return spread.withColumns({"c": F.least("own", "other"), "d": F.greatest("own", "other")}).drop("bucket_n", "own", "other")


BITMAP_BITS = 27  # at most: 16 MB
_BLOCK = 4096  # bytes of a bitmap that travel together


def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """Bits of the 64-bit hashes in ``column`` of ``rows``: 16 for each row, up to 2**BITMAP_BITS.

    Whatever is in the column is in the bitmap; what is not may be, the more often the fuller the bitmap is.
    """
    bits = min(BITMAP_BITS, max(15, int(np.ceil(np.log2(max(rows.count(), 1) * 16)))))
    width = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(width >> 3, np.uint8)
        for batch in batches:
            place = batch.column(0).to_numpy() & (width - 1)
            np.bitwise_or.at(out, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
        blocks = out.reshape(-1, _BLOCK)
        used = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_pydict({"block": pa.array(used, pa.int64()), "bits": pa.array([b.tobytes() for b in blocks[used]], pa.binary())})

    def either(table: pa.Table) -> pa.Table:
        total = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in table.column("bits").to_pylist()])
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([total.tobytes()], pa.binary())})

    # rows of one range of bits go to one task, so tasks do not all send all blocks
    ranged = rows.select(column).where(F.col(column).isNotNull()).repartition(F.expr(f"pmod(`{column}`, {width}) div {_BLOCK * 8}"))
    out = np.zeros((max(1, (width >> 3) // _BLOCK), _BLOCK), np.uint8)
    for r in ranged.mapInArrow(tidied(run), "block bigint, bits binary").groupBy("block").applyInArrow(either, "block bigint, bits binary").collect():
        out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be one the bitmap was made of."""
    place = hashes & (len(bits) * 8 - 1)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def sum_of(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], np.ndarray], like: np.ndarray) -> np.ndarray:
    """The sum over tasks of the matrix that ``work`` makes of the rows of a task, as large as ``like``.

    Blocks of rows travel, those that are not all zero; they are added up within groups of tasks first, so that no task meets the blocks
    of all, and in the order of tasks, so that the sum is the same in every run.
    """
    width, rows_each = like.shape[1], max(1, _BLOCK * 8 // like.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = work(batches).astype(np.float64)
        for k in range(0, len(out), rows_each):
            if out[k : k + rows_each].any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int64()), "sums": pa.array([out[k : k + rows_each].tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = np.sum([np.frombuffer(b) for b in table.column("sums").to_pylist()], axis=0)
        return table.slice(0, 1).set_column(1, "sums", pa.array([total.tobytes()], pa.binary()))

    parts = rows.mapInArrow(tidied(run), "block bigint, sums binary").withColumn("part", F.spark_partition_id())
    kind = "block bigint, sums binary, part int"
    first = parts.groupBy("block", (F.col("part") / 64).cast("int")).applyInArrow(lambda t: add(t), kind)
    total = np.zeros(like.shape)
    for r in stored(first.groupBy("block").applyInArrow(lambda t: add(t), kind), "sums").collect():
        total[r["block"] : r["block"] + rows_each] = np.frombuffer(r["sums"]).reshape(-1, width)
    return total


def mixed(rows: DataFrame, start: np.ndarray, work: Callable[[Iterator[pa.RecordBatch]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The parameters ``start`` after every task has learned from its rows, each beginning with ``start``.

    ``work`` gives a task's parameters and a weight for each of their rows (how often it was met). The mean by these weights is taken.
    """

    def moved(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        own, weights = work(batches)
        return np.concatenate([(own - start) * weights[:, None], weights[:, None]], 1)

    total = sum_of(rows, moved, np.zeros((len(start), start.shape[1] + 1)))
    return start + total[:, :-1] / np.maximum(total[:, -1:], 1)


def text_keys(texts: list[bytes | None]) -> np.ndarray:
    """A 64-bit hash of each text, 0 for a null."""
    return np.array([0 if t is None else xxhash.xxh64_intdigest(t) for t in texts], np.uint64).view(np.int64)


def joined_by_text(
    docs: DataFrame, found: DataFrame, id_col: str, text_col: str, found_id: str, found_key: str, count: str, counts_of: Callable[[list[bytes | None]], list[int]]
) -> tuple[DataFrame, DataFrame]:
    """``docs`` with the column ``count`` (``counts_of`` the texts of a batch), in two parts: joined to ``found`` by id and text key, and the rest.

    A bitmap of the keys in ``found`` tells most of the rest apart, whose texts are then not shuffled. In the first part
    the columns of ``found`` are null where it has no such document.
    """
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(found, found_key))
    own, may = fresh(docs, "own_key"), fresh(docs, "may_be_found")
    fields = T.StructType([T.StructField(own, T.LongType()), T.StructField(may, T.BooleanType()), T.StructField(count, T.LongType())])

    def start():
        def work(column: pa.Array):
            texts = as_bytes(column)
            keys = text_keys(texts)
            return keys.tolist(), in_bitmap(bits.value, keys).tolist(), counts_of(texts)

        return work

    keyed = with_columns(docs.withColumn(text_col, F.col(text_col).cast("string")), [text_col], start, fields)
    some = keyed.where(F.col(may)).join(found, (keyed[id_col] == found[found_id]) & (keyed[own] == found[found_key]), "left")
    return some.drop(own, may, found_id, found_key), keyed.where(~F.col(may)).drop(own, may)
