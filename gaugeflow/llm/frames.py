"""Scratch tables in the shared folder, sized broadcasts, shuffle widths."""

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.session import shared_folder
from gaugeflow.sources import storage

#: Largest frame that is broadcast, in bytes by its counted rows.
BROADCAST_BYTES = 8 * 1024 * 1024


def scratch_folder(spark, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, deleted when the driver ends."""
    folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex[:12]}/{name}"
    return storage.make_temporary(spark, folder)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written as Parquet into the shared folder and read again.

    This cuts the lineage: a lost executor costs its running tasks only.
    """
    spark = frame.sparkSession
    folder = scratch_folder(spark, name)
    frame.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def sized_broadcast(frame: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``frame`` with a broadcast hint if ``rows`` of ``row_bytes`` fit the bound."""
    return F.broadcast(frame) if rows * row_bytes <= BROADCAST_BYTES else frame


def parts(rows: int, rows_per_part: int) -> int:
    return max(1, math.ceil(rows / rows_per_part))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Inside, Spark hands Python at most ``rows`` rows at a time.

    For jobs that run inside the block on rows with whole texts; buffers on either
    side are then a few megabytes. The session's own value comes back afterwards.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slices(batches, rows: int = 256):
    """Arrow batches cut into smaller ones, for code that makes Python objects of them."""
    for batch in batches:
        for start in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(start, rows)
