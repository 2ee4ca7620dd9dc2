"""Sensor readings and lines derived from the ``events`` table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.schemas import ID_FIELDS, MEASURES
from gaugeflow.sources.topic import publish


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event; all measures are multiples of 1/16, so sums are exact."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    measures = {
        "hz": F.floor(F.col("value") * 16) / F.lit(16.0),
        "disp": F.get_json_object("props", "$.k").cast("double") / F.lit(8.0),
        "flo": (F.col("event_id") % 1000).cast("double"),
        "sedPPM": (F.col("user_id") % 97).cast("double") / F.lit(8.0),
        "psi": ((F.col("event_id") * 7919) % 1600).cast("double") / F.lit(16.0),
        "chlPPM": (F.col("event_id") % 13).cast("double") / F.lit(4.0),
    }
    return events.select(
        F.col("event_id").alias("offset"),
        F.concat(F.lit("P"), (F.col("user_id") % 10).cast("string")).alias("resid"),
        F.concat_ws(
            "/",
            F.month("ts").cast("string"),
            F.day("ts").cast("string"),
            F.lpad((F.year("ts") % 100).cast("string"), 2, "0"),
        ).alias("date"),
        F.concat_ws(
            ":",
            F.hour("ts").cast("string"),
            F.lpad(F.minute("ts").cast("string"), 2, "0"),
        ).alias("time"),
        *[measures[measure].alias(measure) for measure in MEASURES],
    )


def reading_lines(readings: DataFrame) -> DataFrame:
    """Readings as comma separated lines."""
    fields = [F.col(name).cast("string") for name in ID_FIELDS + MEASURES]
    return readings.select("offset", F.concat_ws(",", *fields).alias("value"))


def publish_in_segments(
    spark: SparkSession,
    sf_dir: str,
    root: str,
    topic: str,
    segments: int = 4,
    rows_per_file: int = 1_000_000,
) -> int:
    """Publish all events in equal segments of consecutive events.

    Returns the number of files in every segment, which makes one segment one
    micro-batch for a reader that takes that many files at a time.
    """
    lines = reading_lines(event_readings(spark, sf_dir))
    total = lines.count()
    starts = [-(-segment * total // segments) for segment in range(1, segments)]
    files = max(1, -(-total // (segments * rows_per_file)))
    for segment in range(segments):
        part = lines
        if segment > 0:
            part = part.where(F.col("offset") >= starts[segment - 1])
        if segment < segments - 1:
            part = part.where(F.col("offset") < starts[segment])
        publish(part, root, topic, segment=segment, files=files)
    return files
