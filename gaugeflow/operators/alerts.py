"""Low-pressure alerts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.operators.preview import first_rows
from gaugeflow.schemas import LOW_PSI


def low_pressure(frame: DataFrame) -> DataFrame:
    """Rows whose ``psi`` is below the threshold; NaN is not an alert."""
    return frame.where(F.col("psi") < LOW_PSI)


def sample_alert(sensor: DataFrame) -> DataFrame:
    """The first alert in topic order."""
    return first_rows(low_pressure(sensor), 1, "offset")
