"""The same topic records on a Kafka broker; needs Spark's Kafka connector."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.schemas import TOPIC, TOPIC_RECORD
from gaugeflow.sources.topic import keyed_records, topic_names

# Fixed value: how long one poll waits for records.
POLL_TIMEOUT_MS = 1000

# Equal keys share a topic partition, so a busy sensor makes a long one; it is
# read by several tasks of at most this many records.
RECORDS_PER_TASK = 1_000_000


def read_options(
    brokers: str, topics: str, streaming: bool, records_per_batch: int | None = None
) -> dict[str, str]:
    """Connector options: from the earliest offset, bounded by now in a batch."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topic_names(topics)),
        "startingOffsets": "earliest",
        "kafkaConsumer.pollTimeoutMs": str(POLL_TIMEOUT_MS),
        "maxRecordsPerPartition": str(RECORDS_PER_TASK),
    }
    if not streaming:
        options["endingOffsets"] = "latest"
    elif records_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(records_per_batch)
    return options


def read_kafka(
    spark: SparkSession,
    brokers: str,
    topics: str = TOPIC,
    streaming: bool = False,
    records_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    records = (
        reader.format("kafka")
        .options(**read_options(brokers, topics, streaming, records_per_batch))
        .load()
    )
    return records.select(
        *[F.col(field.name).cast(field.dataType) for field in TOPIC_RECORD]
    )


def publish_kafka(lines: DataFrame, brokers: str, topic: str = TOPIC) -> None:
    """Send each line under its key; the broker assigns partition and offset."""
    (
        keyed_records(lines)
        .select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )
