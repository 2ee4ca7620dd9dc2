"""Registered queries and the SQL each is checked against.

Every query works on the whole ``events`` table, read as sensor readings (see
``gaugeflow.plans.event_readings``). The readings are published once per
session and data folder as topic segments, and streamed once into a wide
table; both live under the session's shared folder until the session's JVM
ends, and most queries start from one of them. Queries that publish or ingest themselves do so on each call.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.functions import parse_sensor, record_key, row_key
from gaugeflow.operators import (
    WideTable,
    avg_psi,
    avg_psi_by_day,
    daily_stats,
    first_rows,
    low_pressure,
    reading_count,
    received_count,
    sample_alert,
    sensor_day_report,
    sensor_row_sql,
    sensor_rows,
    sensor_sql,
    stats_cells,
)
from gaugeflow.plans.event_readings import (
    event_readings,
    publish_in_segments,
    reading_lines,
)
from gaugeflow.plans.jobs import latest_readings, publish_files, write_daily_stats
from gaugeflow.schemas import ID_FIELDS, MEASURES, STATISTICS, STATS_RENAMES, TOPIC
from gaugeflow.session import shared_folder
from gaugeflow.sources import storage
from gaugeflow.sources.lines import stream_lines
from gaugeflow.sources.topic import keyed_records, publish, read_topic
from gaugeflow.streaming import (
    RECEIVED,
    REPORT,
    drain,
    drain_counts,
    drain_total,
    read_report,
    sql_report,
    stream_reports,
    stream_to_table,
    stream_to_topic,
)

try:  # a subpackage that may be left out
    from gaugeflow.llm import queries as llm_queries
except ModuleNotFoundError:
    llm_queries = None

ENTRY_DIR = "/root/testdata/sf0.001"
SEGMENTS = 4
REPORT_SCHEMA = "resid string, date string, total bigint, avgpsi double"
SENSOR_SCHEMA = "resid string, date string, time string, " + ", ".join(
    f"{m} double" for m in MEASURES
)


# Prepared data


@dataclass
class Prepared:
    """Topic and table of one data folder, made when first asked for."""

    spark: SparkSession
    sf_dir: str
    root: str
    _files: int | None = field(default=None)
    _table: WideTable | None = field(default=None)
    _reports: str | None = field(default=None)

    def scratch(self, name: str) -> str:
        """A folder no other call uses."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def topic_files(self) -> int:
        """Publish the topic if need be; the number of files per segment."""
        if self._files is None:
            root = f"{self.root}/topics"
            self._files = publish_in_segments(self.spark, self.sf_dir, root, TOPIC, SEGMENTS)
            # A last segment without a record: a micro-batch to skip.
            empty = _lines(self.spark, self.sf_dir).where("false")
            publish(empty, root, TOPIC, segment=SEGMENTS)
        return self._files

    def records(self) -> DataFrame:
        """The whole topic as one batch."""
        self.topic_files()
        return read_topic(self.spark, f"{self.root}/topics")

    def stream(self) -> DataFrame:
        """The topic as a stream, one published segment per micro-batch."""
        files = self.topic_files()
        return read_topic(
            self.spark, f"{self.root}/topics", streaming=True, files_per_batch=files
        )

    def new_table(self, name: str, by_arrival: bool = False) -> WideTable:
        table = WideTable(self.spark, self.scratch(name), by_arrival)
        table.create()
        return table

    def ingest(
        self, table: WideTable, run: str = "first", records: DataFrame | None = None
    ) -> WideTable:
        checkpoint = self.scratch("checkpoint")
        records = self.stream() if records is None else records
        stream_to_table(records, table, run, checkpoint).awaitTermination()
        return table

    def reports(self) -> str:
        """Folder of the built-in reports, streamed once."""
        if self._reports is None:
            root, checkpoint = self.scratch("reports"), self.scratch("checkpoint")
            stream_reports(
                self.stream(), root, "first", checkpoint, REPORT
            ).awaitTermination()
            self._reports = root
        return self._reports

    def table(self) -> WideTable:
        """The topic streamed into a table, with its daily statistics."""
        if self._table is None:
            table = self.ingest(self.new_table("table"))
            write_daily_stats(table)
            self._table = table
        return self._table


_PREPARED: dict[tuple[str, str], Prepared] = {}


def _prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PREPARED:
        root = f"{shared_folder(spark)}/gaugeflow-{uuid.uuid4().hex[:12]}"
        storage.make_temporary(spark, root)
        _PREPARED[key] = Prepared(spark, sf_dir, root)
    return _PREPARED[key]


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Make the shared topic and table ahead of the queries that read them."""
    _prepared(spark, sf_dir).table()


# Lines of the events table


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_lines(event_readings(spark, sf_dir))


def q_publish_lines(spark, sf_dir):
    return keyed_records(_lines(spark, sf_dir)).select("offset", "key", "value")


def q_key_partitions(spark, sf_dir):
    records = keyed_records(_lines(spark, sf_dir))
    return records.groupBy("key").agg(
        F.count(F.lit(1)).alias("messages"),
        (F.max("partition") - F.min("partition") + 1).alias("partitions"),
    )


def q_daily_stats_plan(spark, sf_dir):
    return daily_stats(sensor_rows(latest_readings(_lines(spark, sf_dir))))


# The topic as one batch


def _sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_sensor(_prepared(spark, sf_dir).records(), keep=("offset",))


def q_parse_sensor(spark, sf_dir):
    return _sensor(spark, sf_dir)


def q_received_count(spark, sf_dir):
    return received_count(_sensor(spark, sf_dir))


def q_reading_count(spark, sf_dir):
    return reading_count(_sensor(spark, sf_dir))


def q_avg_psi(spark, sf_dir):
    return avg_psi(_sensor(spark, sf_dir))


def q_sensor_day_report(spark, sf_dir):
    return sensor_day_report(_sensor(spark, sf_dir))


def q_sql_sensor(spark, sf_dir):
    return sensor_sql(
        _sensor(spark, sf_dir),
        "SELECT resid, date, count(resid) AS total, avg(psi) AS avgpsi, "
        "min(psi) AS minpsi FROM sensor GROUP BY resid, date",
    )


def q_preview_20(spark, sf_dir):
    return first_rows(_sensor(spark, sf_dir), 20, "offset")


def q_sample_alert(spark, sf_dir):
    return sample_alert(_sensor(spark, sf_dir))


def q_row_keys(spark, sf_dir):
    sensor = _sensor(spark, sf_dir)
    return sensor.select("offset", row_key().alias("rowkey"), *MEASURES)


def q_alerts(spark, sf_dir):
    alerts = low_pressure(_sensor(spark, sf_dir))
    return alerts.select("offset", row_key().alias("rowkey"), "psi")


def q_latest_readings(spark, sf_dir):
    return latest_readings(_prepared(spark, sf_dir).records())


# Topics


def q_publish_topic(spark, sf_dir):
    """Publish the whole table again and read the records back."""
    root = _prepared(spark, sf_dir).scratch("topics")
    publish_in_segments(spark, sf_dir, root, TOPIC, SEGMENTS)
    return read_topic(spark, root).select("topic", "offset", "key", "value")


def q_publish_files(spark, sf_dir):
    """Lines in files of rising and falling size, published; ranked by offset.

    Files are named by the square root of the event's number in its thousand,
    counted from either end, and ordered as text.
    """
    prepared = _prepared(spark, sf_dir)
    files, root = prepared.scratch("lines"), prepared.scratch("topics")
    number = F.col("offset") % 1000
    part = F.when(number < 500, F.floor(F.sqrt(number))).otherwise(
        100 - F.floor(F.sqrt(999 - number))
    )
    lines = _lines(spark, sf_dir).select("offset", "value", part.alias("part"))
    ordered = lines.repartition(8, "part").sortWithinPartitions("part", "offset")
    ordered.select("value", "part").write.partitionBy("part").text(files)
    publish_files(spark, files, root, TOPIC)
    return _ranked(read_topic(spark, root))


def _ranked(records):
    """Rank by offset among the records of one key."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy("offset"))
    return records.select("key", "value", rank.alias("rank"))


def q_publish_stream(spark, sf_dir):
    """Line files that arrive in four deliveries, published as they come.

    The second delivery is tried twice: the first try is lost after its records were
    written and before its batch was committed.
    """
    prepared = _prepared(spark, sf_dir)
    files, root, checkpoint = (prepared.scratch(n) for n in ("lines", "topics", "checkpoint"))
    lines, (events,) = _lines(spark, sf_dir), _lines(spark, sf_dir).agg(F.count(F.lit(1))).first()
    for delivery in range(SEGMENTS):
        first, end = (-(-events * k // SEGMENTS) for k in (delivery, delivery + 1))
        part = lines.where(F.col("offset").between(first, end - 1))
        # Files of a delivery are in key order by name: equal ranges of its events.
        ordered = part.repartitionByRange(2, "offset").sortWithinPartitions("offset")
        ordered.select("value").write.text(f"{files}/delivery={delivery}")
        stream_to_topic(stream_lines(spark, f"{files}/*"), root, TOPIC, checkpoint).awaitTermination()
        if delivery == 1:
            storage.delete(spark, f"{checkpoint}/commits/1")
    return _ranked(read_topic(spark, root))


def q_several_topics(spark, sf_dir):
    """Two topics in one subscription, streamed into one table."""
    prepared = _prepared(spark, sf_dir)
    root = prepared.scratch("topics")
    lines = _lines(spark, sf_dir)
    low = record_key().isin("P0", "P1", "P2", "P3", "P4")
    publish(lines.where(low), root, "low")
    publish(lines.where(~low), root, "high")
    records = read_topic(spark, root, "low,high", streaming=True)
    table = prepared.new_table("table", by_arrival=True)
    checkpoint = prepared.scratch("checkpoint")
    stream_to_table(records, table, "first", checkpoint).awaitTermination()
    return table.family("data")


def q_contested_topics(spark, sf_dir):
    """Two topics with the same row keys: odd events arrive after the even ones."""
    prepared = _prepared(spark, sf_dir)
    root = prepared.scratch("topics")
    lines = _lines(spark, sf_dir)
    table = prepared.new_table("table", by_arrival=True)
    for place, topic in enumerate(("even", "odd")):
        publish(lines.where(F.col("offset") % 2 == place), root, topic)
        prepared.ingest(table, topic, read_topic(spark, root, topic, streaming=True))
    return table.family("data")


def q_drain_counts(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    root, checkpoint = prepared.scratch("drain"), prepared.scratch("checkpoint")
    drain(prepared.stream(), root, "first", checkpoint)
    return drain_counts(spark, root, "first")


def q_drain_total(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    root, checkpoint = prepared.scratch("drain"), prepared.scratch("checkpoint")
    drain(prepared.stream(), root, "first", checkpoint)
    return drain_total(spark, root, "first")


def q_drain_polls(spark, sf_dir):
    """Drains of at most two and at most nine polls; the first goes on afterwards.

    The topic's empty last segment is no batch that counts.
    """
    prepared = _prepared(spark, sf_dir)
    root = prepared.scratch("drain")
    checkpoints = {polls: prepared.scratch("checkpoint") for polls in (2, 9)}
    for polls, checkpoint in checkpoints.items():
        drain(prepared.stream(), root, f"polls{polls}", checkpoint, polls=polls)
    counts = {f"at most {polls}": drain_counts(spark, root, f"polls{polls}") for polls in checkpoints}
    before = counts["at most 2"].agg(F.sum("messages").alias("messages")).first()["messages"]
    drain(prepared.stream(), root, "polls2", checkpoints[2])
    after = drain_total(spark, root, "polls2").select(F.col("messages") - before)
    rest = after.toDF("messages").select(F.lit(-1).cast("long").alias("batch"), "messages")
    first = drain_counts(spark, root, "polls2").where("batch < 2")
    parts = {"at most 2": first, "at most 9": counts["at most 9"], "the rest": rest}
    named = [part.select(F.lit(name).alias("drain"), "batch", "messages") for name, part in parts.items()]
    return named[0].union(named[1]).union(named[2])


# Reports per micro-batch


def _streamed(spark, sf_dir, reports, name, schema):
    prepared = _prepared(spark, sf_dir)
    root, checkpoint = prepared.scratch("reports"), prepared.scratch("checkpoint")
    stream_reports(
        prepared.stream(), root, "first", checkpoint, reports
    ).awaitTermination()
    return read_report(spark, root, name, "first", schema)


def _sensor_day(spark, sf_dir):
    root = _prepared(spark, sf_dir).reports()
    return read_report(spark, root, "sensor_day", "first", REPORT_SCHEMA)


def q_stream_received(spark, sf_dir):
    """Records of each batch; the topic's last segment is empty and has no row."""
    root = _prepared(spark, sf_dir).reports()
    report = read_report(spark, root, RECEIVED, "first", "received bigint")
    return report.select("batch", "received")


def q_stream_reading_count(spark, sf_dir):
    return _sensor_day(spark, sf_dir).select("batch", "resid", "date", "total")


def q_stream_avg_psi(spark, sf_dir):
    return _sensor_day(spark, sf_dir).select("batch", "resid", "date", "avgpsi")


def q_stream_sql(spark, sf_dir):
    text = "SELECT resid, max(hz) AS maxhz, count(*) AS total FROM sensor GROUP BY resid"
    return _streamed(
        spark,
        sf_dir,
        {"by_sensor": sql_report(text)},
        "by_sensor",
        "resid string, maxhz double, total bigint",
    )


def q_stream_preview_10(spark, sf_dir):
    return _streamed(
        spark,
        sf_dir,
        {"preview": lambda sensor: first_rows(sensor, 10, "offset")},
        "preview",
        f"offset bigint, {SENSOR_SCHEMA}",
    )


def q_stream_sample_alert(spark, sf_dir):
    return _streamed(
        spark,
        sf_dir,
        {"alert": sample_alert},
        "alert",
        f"offset bigint, {SENSOR_SCHEMA}",
    )


# The wide table


def q_ingest_stream(spark, sf_dir):
    """Stream the topic into a new table; rows stored per batch and family."""
    prepared = _prepared(spark, sf_dir)
    table = prepared.ingest(prepared.new_table("table"))
    counts = [
        table.versions(family)
        .groupBy("batch")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(family).alias("family"), "batch", "rows")
        for family in ("data", "alert")
    ]
    return counts[0].union(counts[1])


def q_data_family(spark, sf_dir):
    return _prepared(spark, sf_dir).table().family("data")


def q_alert_family(spark, sf_dir):
    return _prepared(spark, sf_dir).table().family("alert")


def q_stats_family(spark, sf_dir):
    return _prepared(spark, sf_dir).table().family("stats")


def q_table_row_count(spark, sf_dir):
    return _prepared(spark, sf_dir).table().row_count()


def q_scan_data(spark, sf_dir):
    return _prepared(spark, sf_dir).table().scan_family("data")


def q_scan_alert_50(spark, sf_dir):
    return _prepared(spark, sf_dir).table().scan_family("alert", 50)


def q_scan_stats_50(spark, sf_dir):
    return _prepared(spark, sf_dir).table().scan_family("stats", 50)


def q_scan_wide(spark, sf_dir):
    return _prepared(spark, sf_dir).table().scan_wide()


def q_scan_wide_5(spark, sf_dir):
    return _prepared(spark, sf_dir).table().scan_wide(5)


def q_replayed_table(spark, sf_dir):
    """The whole topic twice, the second time from a new checkpoint."""
    prepared = _prepared(spark, sf_dir)
    table = prepared.ingest(prepared.new_table("table"), "run-1")
    prepared.ingest(table, "run-2")
    cells = [f"data_{measure}" for measure in MEASURES]
    return table.scan_wide().select("rowkey", *cells, "alert_psi")


def q_compacted_data(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    table = prepared.ingest(prepared.new_table("table"))
    table.compact("data", idle=True)
    return table.scan_family("data")


def q_compacted_runs(spark, sf_dir):
    """The topic, then its first half again as a second run, compacted in use."""
    prepared = _prepared(spark, sf_dir)
    table = prepared.ingest(prepared.new_table("table", by_arrival=True), "run-9")
    root = prepared.scratch("topics")
    middle, lines = _middle(spark, sf_dir), _lines(spark, sf_dir)
    for first, end in ((0, middle // 2), (middle // 2, middle)):
        publish(lines.where(F.col("offset").between(first, end - 1)), root, TOPIC, files=1)
    records = read_topic(spark, root, streaming=True, files_per_batch=1)
    prepared.ingest(table, "run-10", records)
    table.compact("data")
    return table.family("data")


def _middle(spark, sf_dir):
    """The first event of the topic's second half."""
    (events,) = _lines(spark, sf_dir).agg(F.count(F.lit(1))).first()
    return -(-events // 2)


def _with_tail(spark, sf_dir):
    """A compacted table, then the topic's last quarter once more as a second run."""
    prepared = _prepared(spark, sf_dir)
    table = prepared.ingest(prepared.new_table("table"))
    for family in ("data", "alert"):
        table.compact(family, idle=True)
    root, lines = prepared.scratch("topics"), _lines(spark, sf_dir)
    (events,) = lines.agg(F.count(F.lit(1))).first()
    publish(lines.where(F.col("offset") >= -(-events * (SEGMENTS - 1) // SEGMENTS)), root, TOPIC)
    return prepared.ingest(table, "second", read_topic(spark, root, streaming=True))


def q_data_with_tail(spark, sf_dir):
    """Current rows of compacted days to which repeated readings came since."""
    return _with_tail(spark, sf_dir).family("data")


def q_indexed_scan_50(spark, sf_dir):
    """First rows over key ranges of compacted files and a tail of batches."""
    return _with_tail(spark, sf_dir).scan_family("data", 50)


def q_indexed_wide_5(spark, sf_dir):
    table = _with_tail(spark, sf_dir)
    write_daily_stats(table)
    table.compact("stats", idle=True)
    return table.scan_wide(5)


def q_rerun_new_checkpoint(spark, sf_dir):
    """A run's name is refused to a second checkpoint; its earlier rows remain."""
    prepared = _prepared(spark, sf_dir)
    root = prepared.scratch("topics")
    lines, middle = _lines(spark, sf_dir), _middle(spark, sf_dir)
    publish(lines.where(F.col("offset") < middle), root, "old")
    publish(lines.where(F.col("offset") >= middle), root, "new")
    table = prepared.new_table("table")
    prepared.ingest(table, "first", read_topic(spark, root, "old", streaming=True))
    try:
        prepared.ingest(table, "first", read_topic(spark, root, "new", streaming=True))
    except StreamingQueryException as refused:
        if "another checkpoint" not in str(refused):
            raise
    else:
        raise AssertionError("a second checkpoint took the run's name")
    prepared.ingest(table, "second", read_topic(spark, root, "new", streaming=True))
    return table.family("data")


def q_truncate_table(spark, sf_dir):
    """Rows of each streamed family before and after emptying the table."""
    prepared = _prepared(spark, sf_dir)
    table = prepared.ingest(prepared.new_table("table"))
    families = ("data", "alert")
    before = [table.family(family).count() for family in families]
    table.truncate()
    after = [
        table.family(family)
        .agg(F.count(F.lit(1)).alias("rows_after"))
        .select(
            F.lit(family).alias("family"),
            F.lit(count).cast("long").alias("rows_before"),
            "rows_after",
        )
        for family, count in zip(families, before)
    ]
    return after[0].union(after[1])


# Daily statistics of the table


def _rows(spark, sf_dir):
    return sensor_rows(_prepared(spark, sf_dir).table().family("data"))


def q_sensor_rows(spark, sf_dir):
    return _rows(spark, sf_dir)


def q_avg_psi_by_day(spark, sf_dir):
    return avg_psi_by_day(_rows(spark, sf_dir))


def q_avg_psi_by_day_5(spark, sf_dir):
    return first_rows(avg_psi_by_day(_rows(spark, sf_dir)), 5, "rowkey")


def q_daily_stats(spark, sf_dir):
    return daily_stats(_rows(spark, sf_dir))


def q_daily_stats_5(spark, sf_dir):
    return first_rows(daily_stats(_rows(spark, sf_dir)), 5, "rowkey")


def q_stats_cells(spark, sf_dir):
    return stats_cells(daily_stats(_rows(spark, sf_dir)))


def q_sql_sensor_row(spark, sf_dir):
    return sensor_row_sql(
        _rows(spark, sf_dir), f"SELECT rowkey, {_STATS_SQL} FROM SensorRow GROUP BY rowkey"
    )


def q_write_stats_twice(spark, sf_dir):
    """Stream, write statistics twice: the second run reads no statistics."""
    prepared = _prepared(spark, sf_dir)
    table = prepared.ingest(prepared.new_table("table"))
    write_daily_stats(table)
    write_daily_stats(table)
    return table.family("stats")


def q_incremental_stats(spark, sf_dir):
    """Statistics kept up by changed days: late, repeated and replayed batches.

    The second half comes first; statistics; then the first half, of which a part is
    compacted before statistics saw it; statistics; then a replay of all; statistics.
    """
    prepared = _prepared(spark, sf_dir)
    table, lines, middle = prepared.new_table("table"), _lines(spark, sf_dir), _middle(spark, sf_dir)

    def ingest(run, first, end):
        root = prepared.scratch("topics")
        publish(lines.where((F.col("offset") >= first) & (F.col("offset") < end)), root, TOPIC)
        prepared.ingest(table, run, read_topic(spark, root, streaming=True))

    ingest("late", middle, 1 << 62)
    write_daily_stats(table, changed=True)
    ingest("early", 0, middle // 2)
    table.compact("data", idle=True)
    ingest("rest", middle // 2, middle)
    write_daily_stats(table, changed=True)
    prepared.ingest(table, "again")
    write_daily_stats(table, changed=True)
    return table.family("stats")


# The driver's contract


def entry(spark: SparkSession) -> DataFrame:
    """Daily statistics from lines to result, as one plan."""
    return q_daily_stats_plan(spark, ENTRY_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {
        name.removeprefix("q_"): function
        for name, function in globals().items()
        if name.startswith("q_")
    }
    return {**own, **(llm_queries.queries() if llm_queries else {})}


_STATS_SQL = ", ".join(f"{s}({m}) AS {s}{m}" for m in MEASURES for s in STATISTICS)

_CTE = f"""
WITH readings AS (
  SELECT event_id AS "offset",
         'P' || CAST(user_id % 10 AS VARCHAR) AS resid,
         strftime(ts, '%-m/%-d/%y') AS date,
         strftime(ts, '%-H:%M') AS time,
         floor(value * 16) / 16e0 AS hz,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 8e0 AS disp,
         CAST(event_id % 1000 AS DOUBLE) AS flo,
         CAST(user_id % 97 AS DOUBLE) / 8e0 AS sedPPM,
         CAST((event_id * 7919) % 1600 AS DOUBLE) / 16e0 AS psi,
         CAST(event_id % 13 AS DOUBLE) / 4e0 AS chlPPM,
         least(event_id * {SEGMENTS} // (SELECT count(*) FROM events),
               {SEGMENTS - 1}) AS batch
  FROM events
), lines AS (
  SELECT *, {" || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in ID_FIELDS + MEASURES)}
            AS value
  FROM readings
), keyed AS (
  SELECT *, resid || '_' || date || ' ' || time AS rowkey FROM readings
), data AS (
  SELECT rowkey, {", ".join(MEASURES)} FROM keyed
  QUALIFY row_number() OVER (PARTITION BY rowkey ORDER BY "offset" DESC) = 1
), alert AS (
  SELECT rowkey, psi FROM keyed WHERE psi < 5.0
  QUALIFY row_number() OVER (PARTITION BY rowkey ORDER BY "offset" DESC) = 1
), sensor_row AS (
  SELECT split_part(rowkey, ' ', 1) AS rowkey, {", ".join(MEASURES)} FROM data
), daily AS (
  SELECT rowkey, {_STATS_SQL} FROM sensor_row GROUP BY rowkey
), stats AS (
  SELECT rowkey, {", ".join(f"{a} AS {b}" for a, b in STATS_RENAMES.items())} FROM daily
), wide AS (
  SELECT rowkey,
         {", ".join(f"data.{m} AS data_{m}" for m in MEASURES)},
         alert.psi AS alert_psi,
         {", ".join(f"stats.{c} AS stats_{c}" for c in STATS_RENAMES.values())}
  FROM data FULL JOIN alert USING (rowkey) FULL JOIN stats USING (rowkey)
)
"""

_READING = ", ".join(ID_FIELDS + MEASURES)

_SELECTS = {
    "publish_lines": """SELECT "offset", resid AS key, value FROM lines""",
    "key_partitions": """
        SELECT resid AS key, count(*) AS messages, 1 AS partitions
        FROM lines GROUP BY resid""",
    "parse_sensor": f"""SELECT "offset", {_READING} FROM readings""",
    "received_count": "SELECT count(*) AS received FROM readings",
    "reading_count": """
        SELECT resid, date, count(resid) AS total FROM readings GROUP BY resid, date""",
    "avg_psi": """
        SELECT resid, date, avg(psi) AS avgpsi FROM readings GROUP BY resid, date""",
    "sensor_day_report": """
        SELECT resid, date, count(resid) AS total, avg(psi) AS avgpsi
        FROM readings GROUP BY resid, date""",
    "sql_sensor": """
        SELECT resid, date, count(resid) AS total, avg(psi) AS avgpsi,
               min(psi) AS minpsi
        FROM readings GROUP BY resid, date""",
    "preview_20": f"""
        SELECT "offset", {_READING} FROM readings ORDER BY "offset" LIMIT 20""",
    "sample_alert": f"""
        SELECT "offset", {_READING} FROM readings WHERE psi < 5.0
        ORDER BY "offset" LIMIT 1""",
    "row_keys": f"""SELECT "offset", rowkey, {", ".join(MEASURES)} FROM keyed""",
    "alerts": """SELECT "offset", rowkey, psi FROM keyed WHERE psi < 5.0""",
    "latest_readings": "SELECT * FROM data",
    "daily_stats_plan": "SELECT * FROM daily",
    "publish_topic": """
        SELECT 'sensor' AS topic, "offset", resid AS key, value FROM lines""",
    "publish_files": """
        SELECT resid AS key, value,
               row_number() OVER (
                 PARTITION BY resid ORDER BY 'part=' || CAST(part AS VARCHAR), "offset"
               ) AS rank
        FROM (SELECT *, CAST(CASE WHEN "offset" % 1000 < 500
                                  THEN floor(sqrt("offset" % 1000))
                                  ELSE 100 - floor(sqrt(999 - "offset" % 1000))
                             END AS BIGINT) AS part FROM lines)""",
    "publish_stream": """
        SELECT resid AS key, value, row_number() OVER (PARTITION BY resid ORDER BY "offset") AS rank
        FROM lines""",
    "several_topics": "SELECT * FROM data",
    "drain_counts": "SELECT batch, count(*) AS messages FROM readings GROUP BY batch",
    "drain_polls": """
        SELECT 'at most ' || polls AS drain, batch, count(*) AS messages
        FROM readings, (VALUES (2), (9)) AS p(polls) WHERE batch < polls GROUP BY polls, batch
        UNION ALL SELECT 'the rest', -1, count(*) FROM readings WHERE batch >= 2""",
    "drain_total": "SELECT count(*) AS messages FROM readings",
    "stream_received": """
        SELECT batch, count(*) AS received FROM readings GROUP BY batch""",
    "stream_reading_count": """
        SELECT batch, resid, date, count(resid) AS total
        FROM readings GROUP BY batch, resid, date""",
    "stream_avg_psi": """
        SELECT batch, resid, date, avg(psi) AS avgpsi
        FROM readings GROUP BY batch, resid, date""",
    "stream_sql": """
        SELECT batch, resid, max(hz) AS maxhz, count(*) AS total
        FROM readings GROUP BY batch, resid""",
    "stream_preview_10": f"""
        SELECT batch, "offset", {_READING} FROM readings
        QUALIFY row_number() OVER (PARTITION BY batch ORDER BY "offset") <= 10""",
    "stream_sample_alert": f"""
        SELECT batch, "offset", {_READING} FROM readings WHERE psi < 5.0
        QUALIFY row_number() OVER (PARTITION BY batch ORDER BY "offset") = 1""",
    "ingest_stream": """
        SELECT 'data' AS family, batch, count(*) AS rows FROM readings GROUP BY batch
        UNION ALL
        SELECT 'alert', batch, count(*) FROM readings WHERE psi < 5.0 GROUP BY batch""",
    "data_family": "SELECT * FROM data",
    "alert_family": "SELECT * FROM alert",
    "stats_family": "SELECT * FROM stats",
    "table_row_count": "SELECT count(*) AS rows FROM data",
    "scan_data": "SELECT * FROM data ORDER BY rowkey",
    "scan_alert_50": "SELECT * FROM alert ORDER BY rowkey LIMIT 50",
    "scan_stats_50": "SELECT * FROM stats ORDER BY rowkey LIMIT 50",
    "scan_wide": "SELECT * FROM wide ORDER BY rowkey",
    "scan_wide_5": "SELECT * FROM wide ORDER BY rowkey LIMIT 5",
    "replayed_table": f"""
        SELECT rowkey, {", ".join(f"data.{m} AS data_{m}" for m in MEASURES)},
               alert.psi AS alert_psi
        FROM data FULL JOIN alert USING (rowkey) ORDER BY rowkey""",
    "compacted_data": "SELECT * FROM data ORDER BY rowkey",
    "contested_topics": f"""
        SELECT rowkey, {", ".join(MEASURES)} FROM keyed
        QUALIFY row_number() OVER (
          PARTITION BY rowkey ORDER BY "offset" % 2 DESC, "offset" DESC) = 1""",
    "compacted_runs": f"""
        SELECT rowkey, {", ".join(MEASURES)} FROM keyed
        QUALIFY row_number() OVER (
          PARTITION BY rowkey
          ORDER BY "offset" < (SELECT ceil(count(*) / 2) FROM events) DESC,
                   "offset" DESC) = 1""",
    "data_with_tail": "SELECT * FROM data",
    "indexed_scan_50": "SELECT * FROM data ORDER BY rowkey LIMIT 50",
    "indexed_wide_5": "SELECT * FROM wide ORDER BY rowkey LIMIT 5",
    "incremental_stats": "SELECT * FROM stats",
    "rerun_new_checkpoint": "SELECT * FROM data",
    "truncate_table": """
        SELECT 'data' AS family, (SELECT count(*) FROM data) AS rows_before,
               CAST(0 AS BIGINT) AS rows_after
        UNION ALL
        SELECT 'alert', (SELECT count(*) FROM alert), CAST(0 AS BIGINT)""",
    "sensor_rows": "SELECT * FROM sensor_row",
    "avg_psi_by_day": "SELECT rowkey, avgpsi FROM daily",
    "avg_psi_by_day_5": "SELECT rowkey, avgpsi FROM daily ORDER BY rowkey LIMIT 5",
    "daily_stats": "SELECT * FROM daily",
    "daily_stats_5": "SELECT * FROM daily ORDER BY rowkey LIMIT 5",
    "stats_cells": "SELECT * FROM stats",
    "sql_sensor_row": "SELECT * FROM daily",
    "write_stats_twice": "SELECT * FROM stats",
}


def oracle_sql() -> dict[str, str]:
    own = {name: f"{_CTE}{select}" for name, select in _SELECTS.items()}
    return {**own, **(llm_queries.oracle_sql() if llm_queries else {})}
