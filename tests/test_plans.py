"""Plans that have to hold at scale."""

import re

import pytest
from helpers import frame, line, send, table

import __spark_entry__ as contract
from gaugeflow.functions import parse_sensor
from gaugeflow.operators import wide_table
from gaugeflow.operators import (
    avg_psi_by_day,
    daily_stats,
    first_rows,
    low_pressure,
    sensor_day_report,
    sensor_rows,
)
from gaugeflow.plans.event_readings import event_readings, reading_lines
from gaugeflow.sources.topic import keyed_records, read_topic

SF_DIR = "/root/testdata/sf0.001"


def plan(frame, mode="simple"):
    return frame._sc._jvm.PythonSQLUtils.explainString(
        frame._jdf.queryExecution(), mode
    )


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    made = table(spark, tmp_path_factory.mktemp("plans"))
    lines = frame(spark, [line(f"s{i}", psi=i) for i in range(9)], offsets=True)
    made.put_readings(parse_sensor(lines, keep=("offset",)), "first", 0)
    return made


def test_publishing_does_not_shuffle(spark):
    lines = reading_lines(event_readings(spark, SF_DIR))
    assert "Exchange" not in plan(keyed_records(lines))


def test_parse_splits_once_even_under_a_filter(spark, tmp_path):
    send(spark, tmp_path, [line()])
    text = plan(low_pressure(parse_sensor(read_topic(spark, str(tmp_path)))))
    assert text.count("split(value") == 1
    assert text.count("Generate inline") == 1
    assert "ReadSchema: struct<value:string>" in text


def test_report_is_one_partial_and_one_final_aggregate(spark, tmp_path):
    send(spark, tmp_path, [line()])
    report = sensor_day_report(parse_sensor(read_topic(spark, str(tmp_path))))
    text = plan(report)
    assert text.count("Exchange") == 1
    assert text.count("HashAggregate") == 2


def test_newest_rows_hash_aggregate_before_the_shuffle(made):
    text = plan(made.family("data"))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert text.count("Exchange") == 1
    assert "partial_max_by" in text


def test_only_rows_of_the_tail_are_shuffled(spark, tmp_path, monkeypatch):
    made = table(spark, tmp_path)
    dates = [f"{month}/1/24" for month in range(1, 10)]
    for batch in range(3):
        lines = frame(spark, [line(date=date) for date in dates], offsets=True)
        made.put_readings(parse_sensor(lines, keep=("offset",)), "first", batch)
    made.compact("data", idle=True)
    # Nothing after the base: no shuffle at all.
    assert "Exchange" not in plan(made.family("data"))
    lines = frame(spark, [line(date=dates[4])], offsets=True)
    made.put_readings(parse_sensor(lines, keep=("offset",)), "first", 9)
    rows = made.family("data")
    text = plan(rows)
    # The tail's newest rows and their keys are shuffled; both bases are not.
    shuffled = [part[part.index("FileScan") :] for part in text.split("Exchange hashpartitioning")[1:]]
    assert len(shuffled) == 3 and "SinglePartition" not in text
    assert all(re.search(r"NOT \(run#\d+ = 0base\)", part.split("\n")[0]) for part in shuffled)
    assert re.search(r"NOT \(?day#", text) and "SortMergeJoin" not in text
    assert rows.count() == 9
    # Beyond the bound the contested day is shuffled whole, still no other day.
    monkeypatch.setattr(wide_table, "_TAIL_BYTES", 0)
    rows = made.family("data")
    base, contested = plan(rows).split("HashAggregate", 1)
    assert "Exchange" not in base and re.search(r"NOT \(?day#", base)
    assert contested.count("Exchange") == 1 and "d5-1-24" in contested
    assert "Join" not in contested and plan(rows).count("FileScan") == 2
    assert rows.count() == 9
    # Only per-day partial results of the base are shuffled.
    text = plan(daily_stats(sensor_rows(made.family("data"))))
    assert "partial_max(hz" in re.split(r"NOT \(?day#", text)[0]


def test_daily_stats_shuffle_rows_once_and_partials_once(made):
    text = plan(daily_stats(sensor_rows(made.family("data"))))
    assert text.count("Exchange") == 2
    assert "SortAggregate" not in text


def test_mean_psi_reads_one_measure(made):
    text = plan(avg_psi_by_day(sensor_rows(made.family("data"))))
    assert "ReadSchema: struct<rowkey:string,psi:double,version:decimal(38,0)>" in text


def test_alert_threshold_reaches_the_files(made):
    text = plan(low_pressure(made.versions("data")).select("rowkey", "psi"))
    assert "LessThan(psi,5.0)" in text
    assert "ReadSchema: struct<rowkey:string,psi:double>" in text


def test_newest_value_is_not_filtered_before_it_is_known(made):
    assert "LessThan" not in plan(low_pressure(made.family("data")))


def test_limited_scans_are_top_k(made):
    text = plan(made.scan_family("data", 3))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
    text = plan(made.scan_wide(3))
    assert text.count("TakeOrderedAndProject") >= 3 and "rangepartitioning" not in text


def test_wide_scan_joins_in_place(made):
    text = plan(made.scan_wide())
    assert "CartesianProduct" not in text and "Broadcast" not in text
    assert text.count("SortMergeJoin") == 1
    # One shuffle per family: the join reuses the aggregates' partitioning.
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("Exchange rangepartitioning") == 1


def test_previews_are_top_k(made):
    text = plan(first_rows(avg_psi_by_day(sensor_rows(made.family("data"))), 5, "rowkey"))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_no_query_runs_python_per_row(spark):
    streamed = {"several_topics", "ingest_stream", "truncate_table"}
    for name, query in contract.queries().items():
        if name.startswith(("stream_", "drain_", "publish_", "replayed", "compacted", "contested", "rerun", "incremental")):
            continue
        if name in streamed or name == "write_stats_twice":
            continue
        text = plan(query(spark, SF_DIR))
        for node in ("Python", "CartesianProduct", "BroadcastNestedLoop", "SinglePartition, REPARTITION"):
            assert node not in text, (name, node)


def test_compaction_sorts_by_a_day_that_is_worked_out_once(spark, tmp_path, monkeypatch):
    made, plans = table(spark, tmp_path), []
    lines = frame(spark, [line(f"s{i}", psi=i) for i in range(9)], offsets=True)
    made.put_readings(parse_sensor(lines, keep=("offset",)), "first", 0)
    put = wide_table.WideTable._put

    def spied(self, rows, *args, **kwargs):
        plans.append(plan(rows))
        return put(self, rows, *args, **kwargs)

    monkeypatch.setattr(wide_table.WideTable, "_put", spied)
    made.compact("data", idle=True)
    (text,) = plans
    ordering = [part for part in text.splitlines() if " Sort " in part or "rangepartitioning" in part]
    assert len(ordering) == 2 and not any("regexp_replace" in part for part in ordering)
    assert made.row_count().first()["rows"] == 9
