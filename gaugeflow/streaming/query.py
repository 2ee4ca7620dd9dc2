"""Start a micro-batch query."""

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gaugeflow.schemas import BATCH_INTERVAL


def start(
    records: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    bounded: bool,
) -> StreamingQuery:
    """Hand each micro-batch to ``handle``.

    A bounded query stops at what the topic holds now, an unbounded one takes
    a batch per interval. The checkpoint resumes after the last finished
    batch; a new one replays the topic from the earliest record.
    """
    writer = records.writeStream.foreachBatch(handle).option(
        "checkpointLocation", checkpoint
    )
    if bounded:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=BATCH_INTERVAL).start()


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a started query has written into its checkpoint."""
    (made,) = spark.read.text(f"{checkpoint}/metadata").first()
    return json.loads(made)["id"]
