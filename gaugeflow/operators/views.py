"""Free SQL over the two named relations."""

from pyspark.sql import DataFrame


def _sql(frame: DataFrame, view: str, text: str) -> DataFrame:
    # The frame's own session: a micro-batch runs in a session of its query.
    frame.createOrReplaceTempView(view)
    return frame.sparkSession.sql(text)


def sensor_sql(sensor: DataFrame, text: str) -> DataFrame:
    """Run SQL over parsed readings registered as ``sensor``."""
    return _sql(sensor, "sensor", text)


def sensor_row_sql(rows: DataFrame, text: str) -> DataFrame:
    """Run SQL over day-keyed data rows registered as ``SensorRow``."""
    return _sql(rows, "SensorRow", text)
