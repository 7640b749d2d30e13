"""Running change streams: continuous or until drained, with resume and redelivery safety."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.apply import progress

OnBatch = Callable[[DataFrame, int], None]


def is_missing(error: AnalysisException) -> bool:
    """Nothing has been written yet; any other failure must not pass for that."""
    return error.getCondition() == "PATH_NOT_FOUND"


def start(stream: DataFrame, on_batch: OnBatch, checkpoint: str, every: str | None = None, mode: str = "append") -> StreamingQuery:
    """Hand every micro-batch to ``on_batch``; ``every`` is the commit interval, or None to drain and stop."""
    writer = stream.writeStream.foreachBatch(on_batch).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def drain(stream: DataFrame, on_batch: OnBatch, checkpoint: str, mode: str = "append") -> None:
    """Process all input there is, then stop. How much that was is for the target to tell: Spark keeps the progress of the last batches only."""
    start(stream, on_batch, checkpoint, None, mode).awaitTermination()


def frontier(raw: DataFrame) -> DataFrame:
    """Per topic: every event up to this time has been delivered on all partitions.

    Taken from control rows alone, so a data row ahead of the last resolved mark cannot push it. A
    topic with a partition that has not reported yet has no frontier.
    """
    return progress(raw).groupBy("topic").agg(
        F.when(F.count_if(F.col("frontier").isNull()) == 0, F.min("frontier")).alias("frontier")
    )


def released(changes: DataFrame, marks: DataFrame, event_ms: str = "ts_ms") -> DataFrame:
    """Rows at or below their topic's frontier; later ones are held back until it moves."""
    return changes.join(marks, "topic").filter(F.col(event_ms) <= F.col("frontier")).select(*changes.columns)


def each_table(handlers: Mapping[str, OnBatch], tag: str, others: OnBatch | None = None) -> OnBatch:
    """One batch handler that splits a batch by ``tag`` and computes it once for all tables; ``others`` gets the whole batch."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for name, handle in handlers.items():
                handle(held.filter(F.col(tag) == name), batch_id)
            if others:
                others(held, batch_id)
        finally:
            held.unpersist()

    return on_batch


def tee(hooks: Sequence[OnBatch]) -> OnBatch:
    """Call several handlers on each batch, in order."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        for hook in hooks:
            hook(batch, batch_id)

    return on_batch


def rewrite_folder(path: str) -> OnBatch:
    """A handler that keeps the full result of a complete-mode query at ``path``."""
    return lambda df, _id: df.write.mode("overwrite").parquet(path)


def per_batch_folder(path: str) -> OnBatch:
    """A handler that keeps each batch in its own folder, so a retried batch replaces itself."""
    return lambda df, batch_id: df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").option("basePath", path).parquet(path)
