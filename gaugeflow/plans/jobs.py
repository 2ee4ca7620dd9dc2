"""The batch jobs: publish line files, compute daily statistics."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.keys import row_key
from gaugeflow.functions.parsing import parse_sensor
from gaugeflow.operators.latest import newest
from gaugeflow.operators.preview import first_rows, show
from gaugeflow.operators.stats import daily_stats, sensor_rows
from gaugeflow.operators.wide_table import STATS_RUN, WideTable
from gaugeflow.schemas import MEASURES, STATS_CELLS, STATS_RENAMES
from gaugeflow.session import sized_shuffle
from gaugeflow.sources.lines import placed_lines
from gaugeflow.sources.topic import publish


def publish_files(spark: SparkSession, path: str, root: str, topic: str) -> int:
    """Publish every line of the files under ``path`` and return the segment.

    Offsets follow the files' names and the lines' order in each file.
    """
    with placed_lines(spark, path) as lines:
        return publish(lines, root, topic)


def write_daily_stats(table: WideTable, echo: bool = False, changed: bool = False) -> int:
    """Statistics of every sensor-day in ``data``, written to ``stats``.

    Rows of the stats family are never read: the two families are separate
    folders. ``changed`` reads only the days that batches came to since the last
    statistics; other days keep their rows, and if there is none the last version
    stands. ``echo`` prints previews afterwards, of the statistics as written;
    the rows are counted in the one pass over the data.
    """
    finished = table.finished_batches()
    days = table.changed_days(finished) if changed else None
    if days is not None and not days:
        version, _ = table.seen_batches()
        return version
    seen = Observation()
    with sized_shuffle(table.spark, *table.folders("data", days)):
        data = table.family("data", days).observe(seen, F.count(F.lit(1)).alias("rows"))
        rows = sensor_rows(data)
        version = table.put_stats(daily_stats(rows))
    table.note_seen(version, finished)
    if echo:
        print(f"rows {seen.get['rows']}")
        rows.printSchema()
        written = table.batch_rows("stats", STATS_RUN, version)
        names = {cell: name for name, cell in STATS_RENAMES.items()}
        stats = written.select("rowkey", *STATS_CELLS).withColumnsRenamed(names)
        mean = stats.select("rowkey", "avgpsi")
        show("mean psi", first_rows(mean, 5, "rowkey"))
        show("daily statistics", first_rows(stats, 5, "rowkey"), schema=True)
    return version


def latest_readings(records: DataFrame) -> DataFrame:
    """The data family's rows as a plan over topic records, no table in between."""
    sensor = parse_sensor(records, keep=("offset",))
    return newest(sensor.withColumn("rowkey", row_key()), MEASURES, "offset")
