"""Reports over one batch of readings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def received_count(frame: DataFrame) -> DataFrame:
    """Number of rows, as one row."""
    return frame.agg(F.count(F.lit(1)).alias("received"))


def reading_count(sensor: DataFrame) -> DataFrame:
    """Readings per sensor and day."""
    return sensor.groupBy("resid", "date").agg(F.count("resid").alias("total"))


def avg_psi(sensor: DataFrame) -> DataFrame:
    """Mean pressure per sensor and day."""
    return sensor.groupBy("resid", "date").agg(F.avg("psi").alias("avgpsi"))


def sensor_day_report(sensor: DataFrame) -> DataFrame:
    """Both reports in one pass over the readings and one shuffle."""
    return sensor.groupBy("resid", "date").agg(
        F.count("resid").alias("total"), F.avg("psi").alias("avgpsi")
    )
