"""Session defaults, the shared scratch folder and shuffle sizing."""

import math
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from gaugeflow.sources import storage

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}

# A shuffled row is about twice as large as the compressed Parquet it came from.
_SHUFFLE_EXPANSION = 2
_BYTES_PER_PARTITION = 256 * 1024 * 1024
# Shuffled bytes that a task is worth when each folder it writes costs far more.
_LEAST_TASK_BYTES = "16k"
_LISTING_TASKS_PER_CORE = 2


def get_session(app_name: str = "gaugeflow", **conf: str) -> SparkSession:
    """Session with the project's defaults; master and sizes come from submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = storage.make_temporary(spark, tempfile.mkdtemp(prefix="gaugeflow-"))
    context.setCheckpointDir(folder)
    return folder


@contextmanager
def sized_shuffle(spark: SparkSession, *paths: str) -> Iterator[int]:
    """Inside, ``spark.sql.shuffle.partitions`` is what the input size asks for.

    For jobs that shuffle a whole input and run inside the block; adaptive
    execution merges partitions that turn out small. The session's own value
    is the least and comes back afterwards.
    """
    size = sum(storage.size(spark, path) for path in paths)
    wanted = math.ceil(size * _SHUFFLE_EXPANSION / _BYTES_PER_PARTITION)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    with setting(spark, "spark.sql.shuffle.partitions", str(partitions)):
        yield partitions


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Inside, the session has another value for a setting; its own comes back."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def many_folders_written(spark: SparkSession):
    """Inside, a few rows for many folders are written by several tasks.

    Adaptive execution merges partitions up to its least size, which a folder of a few
    rows does not reach: one task would then open the files of all folders in turn.
    """
    return setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", _LEAST_TASK_BYTES)


def many_folders_listed(spark: SparkSession):
    """Inside, a read lists many folders in a few tasks a core, not in one task each."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    tasks = _LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return setting(spark, name, str(min(tasks, int(spark.conf.get(name)))))
