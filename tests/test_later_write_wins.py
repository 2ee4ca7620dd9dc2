"""The later write wins across runs, topics and compaction; no name loses rows."""

import pytest
from helpers import frame, ingest, line, send, table

from gaugeflow.functions import parse_sensor
from gaugeflow.operators import WideTable
from gaugeflow.sources import storage
from gaugeflow.sources import topic as topics
from gaugeflow.sources.topic import read_topic


def put(spark, made, hz, run, batch, offset=0, owner=None):
    lines = frame(spark, [line(hz=hz)], offsets=True)
    sensor = parse_sensor(lines.selectExpr(f"{offset}L AS offset", "value"), keep=("offset",))
    made.put_readings(sensor, run, batch, owner)


def hz(made):
    return [row["hz"] for row in made.family("data").collect()]


@pytest.mark.parametrize("idle", [True, False])
def test_compaction_keeps_the_order_of_arrival(spark, tmp_path, idle):
    made = table(spark, tmp_path, by_arrival=True)
    put(spark, made, 5.0, "first", 0, 7)
    put(spark, made, 1.0, "first", 1, 8)
    put(spark, made, 2.0, "second", 0)
    put(spark, made, 3.0, "second", 1) if idle else None
    before = hz(made)
    assert before == [3.0 if idle else 2.0]
    made.compact("data", idle=idle)
    assert hz(made) == before
    put(spark, made, 4.0, "second", 2)
    made.compact("data")
    assert hz(made) == [4.0]


def test_runs_count_in_the_order_they_are_first_seen(spark, tmp_path):
    made = table(spark, tmp_path, by_arrival=True)
    for place, run in enumerate(["run-9", "run-10", "a"]):
        put(spark, made, float(place), run, 0)
    assert hz(made) == [2.0]
    put(spark, made, 9.0, "run-9", 3, 99)  # a later batch of the first run
    assert hz(made) == [2.0]


def test_a_later_topic_wins_at_a_smaller_offset(spark, tmp_path):
    send(spark, tmp_path / "topics", [line(time="9:00"), line(hz=1.0)], "one")
    send(spark, tmp_path / "topics", [line(hz=2.0)], "two")
    made = table(spark, tmp_path / "table", by_arrival=True)
    ingest(spark, tmp_path / "topics", made, tmp_path / "c1", "one", "one")
    ingest(spark, tmp_path / "topics", made, tmp_path / "c2", "two", "two")
    found = made.family("data").where("rowkey = 'a_1/1/24 0:00'").collect()
    assert [row["hz"] for row in found] == [2.0]


def test_a_table_keeps_its_mode(spark, tmp_path):
    table(spark, tmp_path / "table", by_arrival=True)
    with pytest.raises(ValueError, match="by_arrival"):
        WideTable(spark, str(tmp_path / "table"))
    assert WideTable(spark, str(tmp_path / "table"), by_arrival=True).family("data").count() == 0


def test_newest_by_arrival_is_found_by_hashing(spark, tmp_path):
    made = table(spark, tmp_path, by_arrival=True)
    put(spark, made, 1.0, "first", 0)
    plan = made.family("data")._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_a_run_name_belongs_to_one_checkpoint(spark, tmp_path):
    send(spark, tmp_path / "topics", [line("a"), line("b")])
    made = table(spark, tmp_path / "table")
    ingest(spark, tmp_path / "topics", made, tmp_path / "c1")
    ingest(spark, tmp_path / "topics", made, tmp_path / "c1")
    send(spark, tmp_path / "other", [line("c")])
    with pytest.raises(Exception, match="another checkpoint"):
        ingest(spark, tmp_path / "other", made, tmp_path / "c2")
    assert made.family("data").count() == 2
    ingest(spark, tmp_path / "other", made, tmp_path / "c3", run="second")
    assert made.family("data").count() == 3
    made.truncate()
    ingest(spark, tmp_path / "other", made, tmp_path / "c4")
    assert made.family("data").count() == 1


def test_two_publishers_lose_no_segment(spark, tmp_path, monkeypatch):
    assert send(spark, tmp_path, [line("a")]) == 0
    listed = storage.folders
    calls = []

    def outdated(session, path):
        calls.append(path)
        return [] if len(calls) == 1 else listed(session, path)

    monkeypatch.setattr(topics.storage, "folders", outdated)
    assert send(spark, tmp_path, [line("b")]) == 1
    found = read_topic(spark, str(tmp_path)).collect()
    assert sorted(row["key"] for row in found) == ["a", "b"]
    assert len({row["offset"] for row in found}) == 2
