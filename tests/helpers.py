"""Small fixtures written as sensor lines."""

from gaugeflow.operators import WideTable
from gaugeflow.sources.topic import publish, read_topic
from gaugeflow.streaming import stream_to_table


def line(resid="a", date="1/1/24", time="0:00", psi=9.0, hz=1.0):
    return f"{resid},{date},{time},{hz},2.0,3.0,4.0,{psi},6.0"


def frame(spark, lines, offsets=False):
    rows = list(enumerate(lines))
    lines = spark.createDataFrame(rows, "offset long, value string")
    return lines if offsets else lines.select("value")


def send(spark, root, lines, topic="sensor", **options):
    """Publish lines in their order as one file."""
    return publish(frame(spark, lines).coalesce(1), str(root), topic, **options)


def table(spark, root, by_arrival=False):
    made = WideTable(spark, str(root), by_arrival)
    made.create()
    return made


def ingest(spark, topics, made, checkpoint, run="first", names="sensor", files=1):
    records = read_topic(
        spark, str(topics), names, streaming=True, files_per_batch=files
    )
    stream_to_table(records, made, run, str(checkpoint)).awaitTermination()


def rows(frame, *columns):
    frame = frame.select(*columns) if columns else frame
    return sorted(tuple(row) for row in frame.collect())
