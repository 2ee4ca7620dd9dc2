"""Line files: one reading per line, no header, no quoting."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Spark's increasing ids keep a record's number within its task in these bits.
_TASK_BITS = 33


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the text files under ``path`` as ``value``, blank lines too."""
    return spark.read.text(path)


def with_parts(lines: DataFrame) -> DataFrame:
    """``lines`` of a text source with the ``file`` and ``start`` of the part they are in."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )


@contextmanager
def placed(lines: DataFrame) -> Iterator[DataFrame]:
    """``value`` and ``position`` of lines as ``with_parts`` gives them.

    A position grows by file name, then by line. Spark reads large files first and
    cuts a file into parts for several tasks. A position is the place of the line's
    part among all parts, then the line's number in its task. Only the list of parts
    is put in order, one row for each, not their lines; it is kept inside the block,
    so that Catalyst knows its size and joins it without a shuffle of the lines
    while it is small.
    """
    number = F.monotonically_increasing_id().bitwiseAND((1 << _TASK_BITS) - 1)
    lines = lines.select("value", "file", "start", number.alias("number"))
    order = F.row_number().over(Window.orderBy("file", "start")).cast("long")
    parts = lines.select("file", "start").distinct().withColumn("part", order).persist()
    parts.count()
    # Parts that were cut differently the second time must not lose their lines.
    part = F.coalesce("part", F.raise_error(F.lit("file parts changed while reading")))
    place = F.shiftleft(part, _TASK_BITS) + F.col("number")
    try:
        joined = lines.join(parts, ["file", "start"], "left")
        yield joined.select("value", place.alias("position"))
    finally:
        parts.unpersist()


@contextmanager
def placed_lines(spark: SparkSession, path: str) -> Iterator[DataFrame]:
    """Every line under ``path`` with its ``position`` among all of them."""
    with placed(with_parts(read_lines(spark, path))) as lines:
        yield lines


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the files that arrive under ``path``, with their parts, as a stream.

    A file is read once; it must be complete when it appears.
    """
    # By default a stream passes over files a week older than the newest.
    reader = spark.readStream.format("text").option("maxFileAge", "36500d")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_parts(reader.load(path))
