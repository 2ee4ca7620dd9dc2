"""Folder operations on whatever file system a path names."""

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

RUN_AND_BATCH = [StructField("run", StringType()), StructField("batch", LongType())]


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it is missing."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(
        status.getPath().getName()
        for status in fs.listStatus(hadoop_path)
        if status.isDirectory()
    )


def claim(spark: SparkSession, folder: str, first: int = 0) -> int:
    """A number from ``first`` on that no other call gets for this folder.

    Its file is created only if it is absent, so that of two callers with the same,
    perhaps outdated, listing one goes on to the next number.
    """
    fs, hadoop_path = _open(spark, folder)
    number = max([first - 1, *claimed(spark, folder)]) + 1
    while True:
        path = spark._jvm.org.apache.hadoop.fs.Path(hadoop_path, f"{number:010d}")
        try:
            fs.create(path, False).close()
            return number
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            number += 1


def claimed(spark: SparkSession, folder: str) -> list[int]:
    """Numbers claimed so far in ``folder``."""
    fs, hadoop_path = _open(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    return sorted(int(name) for name in names if name.isdigit())


def finished(spark: SparkSession, path: str, *names: str) -> dict[tuple[str, ...], int]:
    """When each ``name=value`` folder nested below ``path`` was written to its end."""
    marks = _matching(spark, path, *[f"{name}=*" for name in names], "_SUCCESS")
    found = {}
    for status in marks:
        parts = str(status.getPath()).split("/")[-len(names) - 1 : -1]
        found[tuple(part.split("=", 1)[1] for part in parts)] = status.getModificationTime()
    return found


def _matching(spark: SparkSession, path: str, *patterns: str) -> list:
    fs, _ = _open(spark, path)
    plain = re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
    return fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path("/".join([plain, *patterns]))) or []


def partitions(spark: SparkSession, path: str, *names: str) -> list[tuple[str, ...]]:
    """Values of the ``name=value`` folders nested below ``path``, one listing for all."""
    found = _matching(spark, path, *[f"{name}=*" for name in names])
    paths = [str(status.getPath()).split("/")[-len(names):] for status in found]
    return [tuple(part.split("=", 1)[1] for part in parts) for parts in paths]


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def make(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.mkdirs(hadoop_path)


def make_temporary(spark: SparkSession, path: str) -> str:
    """Make a folder that goes away when the driver's JVM ends."""
    fs, hadoop_path = _open(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def size(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``; zero if it is missing."""
    fs, hadoop_path = _open(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def batch_folder(root: str, run: str, batch: int) -> str:
    return f"{root}/run={run}/batch={batch}"


def write_batch(frame: DataFrame, root: str, run: str, batch: int, *parts: str) -> str:
    """Write one batch to its own folder, so that a retry replaces only itself.

    ``parts`` are columns whose values get folders of their own below it.
    """
    folder = batch_folder(root, run, batch)
    # A dynamic mode of the session would leave a lost try's other folders.
    writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*parts).parquet(folder)
    return folder


def read_batches(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """All batches below ``root`` with ``run`` and ``batch`` as columns."""
    return spark.read.schema(StructType(schema.fields + RUN_AND_BATCH)).parquet(root)
