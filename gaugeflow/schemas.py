"""Names, schemas and constants of the sensor data model."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The nine fields of a sensor line in their order, the pressure
# alert threshold, the topic's partition count and the micro-batch interval.
ID_FIELDS = ("resid", "date", "time")
MEASURES = ("hz", "disp", "flo", "sedPPM", "psi", "chlPPM")
LOW_PSI = 5.0
TOPIC = "sensor"
TOPIC_PARTITIONS = 3
BATCH_INTERVAL = "2 seconds"

# The statistics of each measure, in output order.
STATISTICS = ("max", "min", "avg")


def _columns(names, data_type):
    return [StructField(name, data_type) for name in names]


SENSOR = StructType(
    _columns(ID_FIELDS, StringType()) + _columns(MEASURES, DoubleType())
)
SENSOR_ROW = StructType(
    [StructField("rowkey", StringType())] + _columns(MEASURES, DoubleType())
)

# Statistics carry the function first in query results (``maxhz``) and last in
# the stored family (``hzmax``).
STATS_COLUMNS = tuple(f"{s}{m}" for m in MEASURES for s in STATISTICS)
STATS_CELLS = tuple(f"{m}{s}" for m in MEASURES for s in STATISTICS)
STATS_RENAMES = dict(zip(STATS_COLUMNS, STATS_CELLS))
SENSOR_STATS = StructType(
    [StructField("rowkey", StringType())] + _columns(STATS_COLUMNS, DoubleType())
)

TOPIC_RECORD = StructType(
    [
        StructField("key", StringType()),
        StructField("value", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("topic", StringType()),
    ]
)
