"""Micro-batch jobs."""

import pytest
from helpers import frame, ingest, line, rows, send, table
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gaugeflow.operators import first_rows, received_count, sample_alert
from gaugeflow.plans.jobs import write_daily_stats
from gaugeflow.sources.topic import publish, read_topic
from gaugeflow.streaming import (
    REPORT,
    drain,
    drain_counts,
    drain_total,
    read_report,
    sql_report,
    stream_reports,
    stream_to_table,
)

REPORT_SCHEMA = "resid string, date string, total bigint, avgpsi double"


def stream(spark, topics, files=1):
    return read_topic(spark, str(topics), streaming=True, files_per_batch=files)


@pytest.fixture
def topics(spark, tmp_path):
    """Three segments; sensor a occurs in two of them."""
    folder = tmp_path / "topics"
    send(spark, folder, [line("a", psi=1.0), line("a", psi=3.0), line("b", psi=8.0)])
    send(spark, folder, [line("a", psi=9.0, time="0:01")])
    send(spark, folder, [line("c", "1/2/24", psi=4.0)])
    return folder


def test_reports_are_per_batch_not_running(spark, topics, tmp_path):
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream_reports(
        stream(spark, topics), root, "first", checkpoint
    ).awaitTermination()
    report = read_report(spark, root, "sensor_day", "first", REPORT_SCHEMA)
    assert rows(report, "batch", "resid", "date", "total", "avgpsi") == [
        (0, "a", "1/1/24", 2, 2.0),
        (0, "b", "1/1/24", 1, 8.0),
        (1, "a", "1/1/24", 1, 9.0),
        (2, "c", "1/2/24", 1, 4.0),
    ]


def test_received_is_stored_and_skips_empty_batches(spark, topics, tmp_path):
    send(spark, topics, [])
    send(spark, topics, [line("d"), line("e")])
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream_reports(
        stream(spark, topics), root, "first", checkpoint
    ).awaitTermination()
    found = read_report(spark, root, "received", "first", "received bigint")
    assert rows(found, "batch", "received") == [(0, 3), (1, 1), (2, 1), (4, 2)]
    with pytest.raises(ValueError, match="received"):
        stream_reports(stream(spark, topics), root, "x", checkpoint, {"received": received_count})


def test_checkpoint_resumes_after_the_last_batch(spark, topics, tmp_path):
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    records = stream(spark, topics)
    stream_reports(records, root, "first", checkpoint).awaitTermination()
    send(spark, topics, [line("d", psi=2.0)])
    records = stream(spark, topics)
    stream_reports(records, root, "first", checkpoint).awaitTermination()
    report = read_report(spark, root, "sensor_day", "first", REPORT_SCHEMA)
    assert rows(report, "batch", "resid")[-1] == (3, "d")
    assert report.count() == 5


def test_several_reports_share_a_batch(spark, topics, tmp_path, capsys):
    root = str(tmp_path / "out")
    reports = {
        **REPORT,
        "sql": sql_report("SELECT count(*) AS n FROM sensor WHERE psi < 5.0"),
        "preview": lambda sensor: first_rows(sensor, 2, "offset").select("psi"),
        "alert": lambda sensor: sample_alert(sensor).select("psi"),
    }
    stream_reports(
        stream(spark, topics), root, "first", str(tmp_path / "c"), reports, echo=True
    ).awaitTermination()
    found = read_report(spark, root, "sql", "first", "n bigint")
    assert rows(found, "batch", "n") == [(0, 2), (1, 0), (2, 1)]
    found = read_report(spark, root, "preview", "first", "psi double")
    assert rows(found, "batch", "psi") == [(0, 1.0), (0, 3.0), (1, 9.0), (2, 4.0)]
    found = read_report(spark, root, "alert", "first", "psi double")
    assert rows(found, "batch", "psi") == [(0, 1.0), (2, 4.0)]
    printed = capsys.readouterr().out
    assert "count received 3" in printed and "sensor data" in printed


def test_empty_batches_are_skipped(spark, tmp_path):
    folder = tmp_path / "topics"
    send(spark, folder, [])
    send(spark, folder, [line()])
    root = str(tmp_path / "out")
    count = {"count": received_count}
    stream_reports(
        stream(spark, folder), root, "first", str(tmp_path / "c"), count
    ).awaitTermination()
    found = read_report(spark, root, "count", "first", "received bigint")
    assert [row.received for row in found.collect()] == [1]


def test_bad_line_fails_the_batch_before_any_write(spark, tmp_path):
    folder = tmp_path / "topics"
    send(spark, folder, [line(time="0:01")])
    send(spark, folder, [line(time="0:02"), "a,d,t,BAD,2,3,4,5,6"])
    made = table(spark, tmp_path / "table")
    with pytest.raises(StreamingQueryException, match="malformed sensor line"):
        ingest(spark, folder, made, tmp_path / "c1")
    assert rows(made.family("data"), "rowkey") == [("a_1/1/24 0:01",)]
    reports = {**REPORT, "limited": sql_report("SELECT * FROM sensor LIMIT 1")}
    for name, chosen in (("one", REPORT), ("two", reports)):
        root = str(tmp_path / name)
        with pytest.raises(StreamingQueryException, match="malformed sensor line"):
            stream_reports(
                stream(spark, folder), root, "first", f"{root}-c", chosen
            ).awaitTermination()
        found = read_report(spark, root, "sensor_day", "first", REPORT_SCHEMA)
        assert rows(found, "batch") == [(0,)]


def test_replays_leave_the_table_as_it_was(spark, topics, tmp_path):
    made = table(spark, tmp_path / "table")
    ingest(spark, topics, made, tmp_path / "c1", run="run-1")
    once = [rows(made.family(f), "rowkey", "psi") for f in ("data", "alert")]
    ingest(spark, topics, made, tmp_path / "c1", run="run-1")
    assert made.versions("data").count() == 5
    ingest(spark, topics, made, tmp_path / "c2", run="run-2", files=2)
    assert made.versions("data").count() == 10
    assert [rows(made.family(f), "rowkey", "psi") for f in ("data", "alert")] == once


def test_ingest_goes_on_after_compaction(spark, topics, tmp_path):
    made = table(spark, tmp_path / "table")
    ingest(spark, topics, made, tmp_path / "c")
    made.compact("data", idle=True)
    made.compact("alert", idle=True)
    send(spark, topics, [line("a", psi=2.5)])
    ingest(spark, topics, made, tmp_path / "c")
    assert rows(made.family("data"), "rowkey", "psi") == [
        ("a_1/1/24 0:00", 2.5),
        ("a_1/1/24 0:01", 9.0),
        ("b_1/1/24 0:00", 8.0),
        ("c_1/2/24 0:00", 4.0),
    ]
    assert rows(made.family("alert"), "psi") == [(2.5,), (4.0,)]


def test_several_topics_stream_into_one_table(spark, tmp_path):
    folder = tmp_path / "topics"
    send(spark, folder, [line("a", psi=1.0)], topic="one")
    send(spark, folder, [line("b", psi=2.0), line("a", psi=6.0)], topic="two")
    made = table(spark, tmp_path / "table", by_arrival=True)
    ingest(spark, folder, made, tmp_path / "c", names="one,two")
    assert rows(made.family("data"), "rowkey", "psi") == [
        ("a_1/1/24 0:00", 6.0),
        ("b_1/1/24 0:00", 2.0),
    ]
    assert rows(made.family("alert"), "psi") == [(1.0,), (2.0,)]


def test_drain_counts_each_batch_and_stops(spark, topics, tmp_path):
    send(spark, topics, [])
    root = str(tmp_path / "drain")
    drain(stream(spark, topics), root, "first", str(tmp_path / "c"))
    assert rows(drain_counts(spark, root, "first")) == [(0, 3), (1, 1), (2, 1)]
    assert drain_total(spark, root, "first").first().messages == 5
    # Unlike the parse, a drain looks at no line.
    send(spark, topics, ["not,a,reading"])
    drain(stream(spark, topics), root, "first", str(tmp_path / "c"))
    assert drain_total(spark, root, "first").first().messages == 6


def test_unbounded_query_takes_a_batch_per_interval(spark, topics, tmp_path):
    made = table(spark, tmp_path / "table")
    query = stream_to_table(
        stream(spark, topics, files=10), made, "first", str(tmp_path / "c"), False
    )
    try:
        query.processAllAvailable()
        assert made.versions("data").count() == 5
        send(spark, topics, [line("z")])
        query.processAllAvailable()
        assert made.versions("data").where(F.col("batch") > 0).count() == 1
    finally:
        query.stop()


def test_stream_equals_batch(spark, tmp_path):
    lines = [line(f"s{i % 7}", time=f"{i % 11}:0", psi=i % 13) for i in range(400)]
    folder = tmp_path / "topics"
    for part in range(4):
        batch = frame(spark, lines, offsets=True).where(
            F.col("offset").between(part * 100, part * 100 + 99)
        )
        publish(batch, str(folder), files=2)
    streamed = table(spark, tmp_path / "streamed")
    ingest(spark, folder, streamed, tmp_path / "c", files=3)
    whole = table(spark, tmp_path / "whole")
    ingest(spark, folder, whole, tmp_path / "c2", files=100)
    for family in ("data", "alert"):
        assert rows(streamed.family(family), "rowkey", "psi") == rows(
            whole.family(family), "rowkey", "psi"
        )


def test_previews_cost_one_parse_and_one_pass(spark, topics, tmp_path, capsys):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def tick(value):
        seen.add(1)
        return value

    records = stream(spark, topics).withColumn("value", tick.asNondeterministic()("value"))
    made = table(spark, tmp_path / "table")
    stream_to_table(
        records, made, "first", str(tmp_path / "c"), echo=True
    ).awaitTermination()
    assert seen.value == 5
    assert "first alert" in capsys.readouterr().out
    write_daily_stats(made, echo=True)
    printed = capsys.readouterr().out
    assert "rows 4" in printed and "maxhz" in printed
