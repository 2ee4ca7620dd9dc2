"""Reports over each micro-batch of a topic, not running totals."""

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gaugeflow.functions.parsing import parse_sensor
from gaugeflow.operators.preview import show
from gaugeflow.operators.reports import avg_psi, reading_count, sensor_day_report
from gaugeflow.operators.views import sensor_sql
from gaugeflow.sources import storage
from gaugeflow.streaming.query import start

#: The stored report that every run makes: records received per batch.
RECEIVED = "received"

Report = Callable[[DataFrame], DataFrame]

REPORT: dict[str, Report] = {"sensor_day": sensor_day_report}

#: Reports that read every row of a batch once, whatever the optimizer does.
_READ_ALL = (avg_psi, reading_count, sensor_day_report)


def _observed(seen: Observation, batch: DataFrame) -> int:
    """The records that a finished report has read.

    A plan that turned out empty is cut short and leaves no metric; such a batch is
    counted, which reads no column.
    """
    try:
        return seen.get[RECEIVED]
    except (KeyError, Py4JJavaError, PySparkException):
        return batch.count()


def sql_report(text: str) -> Report:
    """A report written as SQL over the batch's ``sensor`` relation."""
    return lambda sensor: sensor_sql(sensor, text)


def stream_reports(
    records: DataFrame,
    root: str,
    run: str,
    checkpoint: str,
    reports: dict[str, Report] = REPORT,
    bounded: bool = True,
    echo: bool = False,
) -> StreamingQuery:
    """Run every report on every non-empty batch and keep the results.

    Result ``name`` of a batch goes to its own folder below ``<root>/<name>``, the
    number of its records to ``<root>/received``. A single report parses the batch as
    it reads it, and if it is one of those that read every row, an observed metric
    counts the records in the same pass; otherwise a job that reads no column counts
    them first. Several reports share one parsed copy, whose count is run first so
    that a bad line fails the batch before anything is written. ``echo`` prints the
    results.
    """

    if RECEIVED in reports:
        raise ValueError(f"every run stores a report {RECEIVED!r} already")
    shared = len(reports) > 1 or echo
    observed = not shared and all(report in _READ_ALL for report in reports.values())

    def handle(batch: DataFrame, number: int) -> None:
        session, seen = batch.sparkSession, Observation()
        sensor = parse_sensor(batch, keep=("offset",))
        if shared:
            sensor = sensor.persist()
        elif observed:
            sensor = sensor.observe(seen, F.count(F.lit(1)).alias(RECEIVED))
        try:
            received = None if observed else (sensor if shared else batch).count()
            if received == 0:
                return
            if echo:
                show("sensor data", sensor)
            for name, report in reports.items():
                written = storage.write_batch(
                    report(sensor), f"{root}/{name}", run, number
                )
                if echo:
                    show(name, session.read.parquet(written))
                if observed:
                    received = _observed(seen, batch)
                    if received == 0:
                        storage.delete(session, written)
                        return
            # Last, after every line has parsed.
            counted = session.range(0, 1, 1, 1).select(F.lit(received).cast("long").alias(RECEIVED))
            storage.write_batch(counted, f"{root}/{RECEIVED}", run, number)
            if echo:
                print(f"count received {received}")
        finally:
            if shared:
                sensor.unpersist()

    return start(records, handle, checkpoint, bounded)


def read_report(
    spark: SparkSession, root: str, name: str, run: str, schema: str
) -> DataFrame:
    """Stored results of one report with the number of their batch."""
    results = storage.read_batches(
        spark, f"{root}/{name}", StructType.fromDDL(schema)
    )
    return results.where(F.col("run") == run).drop("run")
