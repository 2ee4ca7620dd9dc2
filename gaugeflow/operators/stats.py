"""Daily statistics over the rows of the data family."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.keys import day_key
from gaugeflow.schemas import MEASURES, SENSOR_STATS, STATISTICS, STATS_RENAMES


def sensor_rows(data: DataFrame) -> DataFrame:
    """Data rows under their day key, the time cut off."""
    return data.select(day_key().alias("rowkey"), *MEASURES)


def avg_psi_by_day(rows: DataFrame) -> DataFrame:
    """Mean pressure per day key."""
    return rows.groupBy("rowkey").agg(F.avg("psi").alias("avgpsi"))


def daily_stats(rows: DataFrame) -> DataFrame:
    """Maximum, minimum and mean of all six measures per day key."""
    return rows.groupBy("rowkey").agg(
        *[
            getattr(F, statistic)(measure).alias(f"{statistic}{measure}")
            for measure in MEASURES
            for statistic in STATISTICS
        ]
    )


def stats_cells(stats: DataFrame) -> DataFrame:
    """Daily statistics under the names of the stats family's cells."""
    found = [(f.name, f.dataType) for f in stats.schema]
    expected = [(f.name, f.dataType) for f in SENSOR_STATS]
    if found != expected:
        raise TypeError(f"not daily statistics: {stats.schema.simpleString()}")
    return stats.withColumnsRenamed(STATS_RENAMES)
