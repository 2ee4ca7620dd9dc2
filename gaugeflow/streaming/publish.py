"""Publish line files to a topic as they arrive."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gaugeflow.sources.lines import placed
from gaugeflow.sources.topic import publish, segment_of
from gaugeflow.streaming.query import checkpoint_id, start


def stream_to_topic(
    lines: DataFrame, root: str, topic: str, checkpoint: str, bounded: bool = True
) -> StreamingQuery:
    """Append each micro-batch of ``lines`` (see ``stream_lines``) as one segment.

    A batch has a segment of its own, bound to the checkpoint and the batch's number,
    so that a batch that is tried again replaces what the lost try wrote and every
    line is published once. Offsets grow from batch to batch; within one they follow
    the files' names, then their lines.
    """
    owner: list[str] = []

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if not owner:
            owner.append(checkpoint_id(spark, checkpoint))
        with placed(batch) as ordered:
            publish(ordered, root, topic, segment_of(spark, root, topic, owner[0], number))

    return start(lines, handle, checkpoint, bounded)
