"""Keyed topics kept as folders of Parquet files.

A topic is ``<root>/topic=<name>/segment=<n>``; every publish call adds one
segment. Records have the same columns as records read from a broker.
"""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gaugeflow.functions.keys import record_key
from gaugeflow.schemas import TOPIC, TOPIC_PARTITIONS, TOPIC_RECORD
from gaugeflow.sources import storage

_NAME = re.compile(r"[A-Za-z0-9._-]+")
# Spark's readers pass over folders whose names begin like these.
_CLAIMS = "_claims"
_OWNED = "_owned"
_STORED = StructType(
    TOPIC_RECORD.fields + [StructField("segment", IntegerType())]
)


def topic_names(topics: str) -> list[str]:
    """Distinct names in a comma separated subscription."""
    names = sorted(set(topics.split(",")))
    for name in names:
        if not _NAME.fullmatch(name):
            raise ValueError(f"not a topic name: {name!r}")
    return names


def topic_folder(root: str, topic: str) -> str:
    (name,) = topic_names(topic)
    return f"{root}/topic={name}"


def keyed_records(lines: DataFrame, partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Add the record key and its topic partition; equal keys share a partition."""
    return lines.withColumn("key", record_key()).withColumn(
        "partition", F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int")
    )


def _next_offset(spark: SparkSession, folder: str, segments: list[int]) -> int:
    """One past the largest offset; later segments hold larger offsets."""
    for segment in reversed(segments):
        records = spark.read.schema(TOPIC_RECORD).parquet(f"{folder}/segment={segment}")
        (last,) = records.agg(F.max("offset")).first()
        if last is not None:
            return last + 1
    return 0


def publish(
    lines: DataFrame,
    root: str,
    topic: str = TOPIC,
    segment: int | None = None,
    files: int | None = None,
) -> int:
    """Append lines to a topic as keyed records and return the segment number.

    Nothing is shuffled: each task keys and writes its own lines. Offsets grow
    from call to call, with gaps between tasks, and follow the lines' ``position``
    if they have one. Lines that already have an ``offset`` column keep it. Naming a ``segment`` makes a repeated call replace
    what the first wrote; without a name a new segment is written, also if
    another publisher takes its number first. ``files`` spreads the segment over
    that many files, for readers that take a number of files per batch.
    """
    spark = lines.sparkSession
    folder = topic_folder(root, topic)

    def write(number: int, known: list[int], mode: str) -> None:
        numbered = lines
        if "offset" not in lines.columns:
            first = _next_offset(spark, folder, [n for n in known if n < number])
            placed = "position" in lines.columns
            place = F.col("position") if placed else F.monotonically_increasing_id()
            numbered = lines.withColumn("offset", place + first)
        records = keyed_records(numbered).select(
            "key", "value", "partition", "offset", F.current_timestamp().alias("timestamp")
        )
        if files is not None:
            records = records.repartition(files, "offset")
        records.write.mode(mode).parquet(f"{folder}/segment={number}")

    if segment is not None:
        write(segment, _segments(spark, folder), "overwrite")
        return segment
    while True:
        number = storage.claim(spark, f"{folder}/{_CLAIMS}", max(_segments(spark, folder), default=-1) + 1)
        try:
            # Listed again: the claim may be past segments that the first listing lacked.
            write(number, _segments(spark, folder), "errorifexists")
            return number
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise


def segment_of(spark: SparkSession, root: str, topic: str, owner: str, batch: int) -> int:
    """The segment that belongs to a publisher's batch, claimed when first asked for.

    A batch that is published again gets the segment it had, so that naming it
    replaces what a lost try wrote; no other publisher gets its number.
    """
    folder = topic_folder(root, topic)
    owned = f"{folder}/{_OWNED}"
    for name in storage.folders(spark, owned):
        number, *whose = name.split(".")
        if whose == [owner, str(batch)]:
            return int(number)
    number = storage.claim(spark, f"{folder}/{_CLAIMS}", max(_segments(spark, folder), default=-1) + 1)
    storage.make(spark, f"{owned}/{number:010d}.{owner}.{batch}")
    return number


def _segments(spark: SparkSession, folder: str) -> list[int]:
    names = storage.folders(spark, folder)
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("segment="))


def read_topic(
    spark: SparkSession,
    root: str,
    topics: str = TOPIC,
    streaming: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Records of one or more topics from the earliest, as a batch or a stream."""
    folders = ",".join(f"topic={name}" for name in topic_names(topics))
    # Braces for one topic as well: a stream keeps basePath only with a pattern.
    path = f"{root}/{{{folders}}}"
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(_STORED).option("basePath", root)
    if streaming:
        # By default a stream passes over files a week older than the newest.
        reader = reader.option("maxFileAge", "36500d")
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select(*TOPIC_RECORD.fieldNames())
