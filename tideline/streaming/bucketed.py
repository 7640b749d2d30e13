"""A mirror table whose base and changes are bucketed alike, so that they meet without a shuffle."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.names import quote
from tideline.operators.apply import position, reduce_latest
from tideline.streaming.run import is_missing


_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class BucketedMirror:
    """Latest state by key in two bucketed Parquet tables, ``changes`` and ``base``, that share keys and bucket count.

    A batch writes its reduced changes into its own partition of ``changes`` and replaces it when retried. A read joins the base and the
    reduced changes bucket by bucket: nothing is exchanged, and the base is read once. ``base`` is also cut into ``slots`` by another hash of
    the key. ``compact`` folds the changes into new versions of the slots they touch and leaves the others; which version of a slot
    holds is recorded last, in one small file, under the number of the new base, so a lost run changes nothing. Changes stand under the number of the base
    they came after; a batch that is delivered again after a compaction is merged once more, to no effect. ``write_batch`` compacts by itself
    once the pending changes exceed ``compact_bytes`` and, where the base has more than ``small_base`` bytes, a quarter of what it has beyond
    them. So a growing base is rewritten ever more rarely, and all compactions together write a few times its size.

    ``schema`` maps the columns of a batch to their types. The tables live under ``path``; their names in the session's catalog follow
    from it, so a new session finds the same buckets again.
    """

    path: str
    keys: tuple[str, ...]
    pos: tuple[str, ...]
    schema: Mapping[str, str]
    buckets: int = 32
    slots: int = 16
    compact_bytes: int | None = None
    small_base: int = 16 << 20

    def _table(self, spark: SparkSession, kind: str) -> str:
        name = f"mirror_{hashlib.md5(self.path.encode()).hexdigest()[:16]}_{kind}"
        parts = {"changes": "after BIGINT, batch_id BIGINT", "base": "version BIGINT, slot INT"}[kind]
        columns = ", ".join(f"{quote(n)} {t}" for n, t in self.schema.items())
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {parts}) USING parquet PARTITIONED BY ({', '.join(p.split()[0] for p in parts.split(', '))}) "
            f"CLUSTERED BY ({', '.join(map(quote, self.keys))}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{kind}'"
        )
        return name

    def _rows(self, spark: SparkSession, kind: str) -> DataFrame:
        """All partitions there are, also those that another session has written."""
        name = self._table(spark, kind)
        try:
            spark.read.schema("batch_id bigint").parquet(f"{self.path}/{kind}")
        except AnalysisException as error:
            if not is_missing(error):
                raise
        else:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return spark.table(name)

    def _insert(self, df: DataFrame, kind: str, *parts: str) -> None:
        """Replace the partitions that ``df`` has rows of; one file for each bucket of a partition."""
        spark, name = df.sparkSession, self._table(df.sparkSession, kind)
        dealt = df.select(*[F.col(quote(c)).cast(t) for c, t in self.schema.items()], *parts).repartition(self.buckets, *[F.col(quote(k)) for k in self.keys])
        before = spark.conf.get(_OVERWRITE)
        spark.conf.set(_OVERWRITE, "dynamic")  # a writer's own option does not reach insertInto
        try:
            dealt.write.mode("overwrite").insertInto(name)
        finally:
            spark.conf.set(_OVERWRITE, before)
        spark.catalog.refreshTable(name)

    def _versions(self, spark: SparkSession) -> tuple[int, dict[int, int]]:
        """The number of the base, -1 before the first, and the version of each slot in it."""
        try:
            found = spark.read.schema("number bigint, slot int, version bigint").parquet(f"{self.path}/commits").collect()
        except AnalysisException as error:
            if not is_missing(error):
                raise
            found = []
        last = max((r.number for r in found), default=-1)
        return last, {r.slot: r.version for r in found if r.number == last}

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(quote(k)) for k in self.keys]), F.lit(self.slots)).cast("int")

    def write_batch(self, flat: DataFrame, batch_id: int) -> None:
        spark = flat.sparkSession
        after, _ = self._versions(spark)
        marks = {"after": F.lit(after).cast("bigint"), "batch_id": F.lit(batch_id).cast("bigint")}
        self._insert(reduce_latest(flat, self.keys, self.pos).withColumns(marks), "changes", "after", "batch_id")
        if self.compact_bytes is not None:
            pending = self.pending_bytes(spark)
            if pending > self.compact_bytes and 4 * pending >= self.base_bytes(spark) - self.small_base:
                self.compact(spark)

    def changes(self, spark: SparkSession) -> DataFrame:
        """Reduced changes of each batch since the base, with ``batch_id``."""
        after, _ = self._versions(spark)
        return self._rows(spark, "changes").filter(F.col("after") == after).drop("after")

    def pending_bytes(self, spark: SparkSession) -> int:
        files = self.changes(spark).select("_metadata.file_path", "_metadata.file_size").distinct()
        return files.agg(F.coalesce(F.sum("file_size"), F.lit(0))).head()[0]

    def base_bytes(self, spark: SparkSession) -> int:
        """Size of the versions that hold, from a listing of their files."""
        holds = self._holds(spark)
        if holds is None:
            return 0
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{self.path}/base")
        return files.filter(holds).agg(F.coalesce(F.sum("length"), F.lit(0))).head()[0]

    def _holds(self, spark: SparkSession, slots: set[int] | None = None) -> Column | None:
        """Which partitions of ``base`` hold, of all slots or of some; None when none do."""
        _, versions = self._versions(spark)
        wanted: dict[int, list[int]] = {}
        for slot, version in versions.items():
            if slots is None or slot in slots:
                wanted.setdefault(version, []).append(slot)
        hold = [(F.col("version") == v) & F.col("slot").isin(s) for v, s in wanted.items()]
        return reduce(Column.__or__, hold) if hold else None

    def _base(self, spark: SparkSession, slots: set[int] | None = None) -> DataFrame:
        """Rows of the versions that hold, of all slots or of some; other versions are not read."""
        holds = self._holds(spark, slots)
        return self._rows(spark, "base").filter(F.lit(False) if holds is None else holds).drop("version", "slot")

    def _merged(self, base: DataFrame, changes: DataFrame) -> DataFrame:
        """Newest event of each key of both sides, whichever has it."""
        newer = reduce_latest(changes, self.keys, self.pos)
        rest = [c for c in self.schema if c not in self.keys]
        sides = [df.select(*[F.col(quote(k)) for k in self.keys], F.struct(*[F.col(quote(c)) for c in rest]).alias(n)) for df, n in ((base, "_old"), (newer, "_new"))]
        both = sides[0].join(sides[1], list(self.keys), "full")
        old, new = (F.struct(*[F.col(side)[p] for p in self.pos if p not in self.keys]) for side in ("_old", "_new"))
        stays = F.col("_new").isNull() | (F.col("_old").isNotNull() & (old > new))
        chosen = F.when(stays, F.col("_old")).otherwise(F.col("_new"))
        return both.select(*[F.col(quote(k)) for k in self.keys], chosen.alias("_row")).select(
            *[F.col(quote(c)) if c in self.keys else F.col("_row")[c].alias(c) for c in self.schema]
        )

    def state(self, spark: SparkSession) -> DataFrame:
        """Newest event per key with ``op`` and positions, deletes included."""
        return self._merged(self._base(spark), self.changes(spark).drop("batch_id"))

    def read(self, spark: SparkSession) -> DataFrame:
        live = self.state(spark).filter(F.col("op") != "d")
        return live.select(*[F.col(quote(c)) for c in self.schema if c in self.keys or c not in ("op", *self.pos)])

    def compact(self, spark: SparkSession) -> int:
        """Fold the pending changes into the base; only slots they touch are read and written. Deletes stay: a late redelivery of an
        older event must still lose against them."""
        last, versions = self._versions(spark)
        changes = self.changes(spark)
        touched = set(changes.agg(F.collect_set(self._slot())).head()[0])  # at most ``slots`` numbers
        if not touched:
            return last
        number = last + 1
        merged = self._merged(self._base(spark, touched), changes.drop("batch_id"))
        self._insert(merged.withColumns({"version": F.lit(number).cast("bigint"), "slot": self._slot()}), "base", "version", "slot")
        held = versions | dict.fromkeys(touched, number)
        rows = spark.createDataFrame([(number, s, v) for s, v in held.items()], "number bigint, slot int, version bigint")
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return number
