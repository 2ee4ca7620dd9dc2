"""Read a topic to its current end and count what was received."""

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gaugeflow.operators.reports import received_count
from gaugeflow.sources import storage
from gaugeflow.streaming.query import start

_COUNTS = StructType([StructField("messages", LongType())])


_ENOUGH = "as many polls as asked for"


def drain(
    records: DataFrame,
    root: str,
    run: str,
    checkpoint: str,
    polls: int | None = None,
    seconds: float | None = None,
) -> int:
    """Count every batch up to the topic's end and return how many were counted.

    The count reads no column of the records. ``polls`` and ``seconds`` stop earlier:
    after that many batches, or when the time is over, of which no batch begins
    after it and the one at work is finished. What is left stays in the topic; the
    same checkpoint goes on there. At the topic's end further polls would be empty.
    """
    counted = 0
    end = None if seconds is None else time.monotonic() + seconds

    def handle(batch: DataFrame, number: int) -> None:
        nonlocal counted
        if counted == polls or end is not None and time.monotonic() >= end:
            # A batch that fails is not committed, so that none is lost.
            raise StopIteration(_ENOUGH)
        counts = received_count(batch).withColumnRenamed("received", "messages")
        storage.write_batch(counts, root, run, number)
        counted += 1

    try:
        start(records, handle, checkpoint, bounded=True).awaitTermination()
    except StreamingQueryException as stopped:
        if _ENOUGH not in str(stopped):
            raise
    return counted


def drain_counts(spark: SparkSession, root: str, run: str) -> DataFrame:
    """Messages of each non-empty batch of a drain."""
    return (
        storage.read_batches(spark, root, _COUNTS)
        .where((F.col("run") == run) & (F.col("messages") > 0))
        .select("batch", "messages")
    )


def drain_total(spark: SparkSession, root: str, run: str) -> DataFrame:
    """Messages of the whole drain."""
    counts = drain_counts(spark, root, run)
    return counts.agg(F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"))
