"""Keyed topics."""

import pytest
from helpers import frame, line, send

from gaugeflow.plans.jobs import publish_files
from gaugeflow.schemas import TOPIC_PARTITIONS, TOPIC_RECORD
from gaugeflow.sources.kafka import read_options
from gaugeflow.sources.lines import read_lines
from gaugeflow.sources.topic import keyed_records, publish, read_topic, topic_names


def test_key_is_text_before_first_comma(spark):
    texts = ["P1,rest,of,line", "nocomma", "", ",x", '"q,r"']
    keys = [row.key for row in keyed_records(frame(spark, texts)).collect()]
    assert keys == ["P1", "nocomma", "", "", '"q']


def test_equal_keys_share_a_partition(spark):
    records = keyed_records(frame(spark, [line(f"P{i % 40}") for i in range(400)]))
    pairs = records.select("key", "partition").distinct().collect()
    assert len(pairs) == 40
    assert {row.partition for row in pairs} == set(range(TOPIC_PARTITIONS))


def test_record_schema(spark, tmp_path):
    send(spark, tmp_path, [line()])
    records = read_topic(spark, str(tmp_path))
    assert records.columns == TOPIC_RECORD.fieldNames()
    (record,) = records.collect()
    assert (record.key, record.value, record.topic) == ("a", line(), "sensor")
    assert record.timestamp is not None


def test_offsets_grow_in_order_and_over_calls(spark, tmp_path):
    assert send(spark, tmp_path, ["x,1", "x,2"]) == 0
    assert send(spark, tmp_path, []) == 1
    assert send(spark, tmp_path, ["x,3", "x,4"]) == 2
    records = read_topic(spark, str(tmp_path)).orderBy("offset").collect()
    assert [row.value for row in records] == ["x,1", "x,2", "x,3", "x,4"]
    assert len({row.offset for row in records}) == 4


def test_named_segment_is_replaced(spark, tmp_path):
    send(spark, tmp_path, ["x,1"], segment=0)
    send(spark, tmp_path, ["x,2"], segment=1)
    send(spark, tmp_path, ["x,3"], segment=1)
    records = read_topic(spark, str(tmp_path)).orderBy("offset").collect()
    assert [row.value for row in records] == ["x,1", "x,3"]


def test_files_per_segment(spark, tmp_path):
    lines = frame(spark, [line(f"P{i}") for i in range(50)])
    publish(lines, str(tmp_path), files=3)
    assert len(list((tmp_path / "topic=sensor" / "segment=0").glob("*.parquet"))) == 3


def test_line_file_keeps_order_and_blank_lines(spark, tmp_path):
    texts = [f"P{i % 7},{i}" for i in range(20_000)]
    texts[5] = ""
    source = tmp_path / "sensor.csv"
    source.write_text("\n".join(texts) + "\n")
    # Many splits of one file: offsets must still follow the file.
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    session.conf.set("spark.sql.files.openCostInBytes", "1")
    assert read_lines(session, str(source)).rdd.getNumPartitions() > 4
    publish_files(session, str(source), str(tmp_path / "topics"), "sensor")
    records = read_topic(spark, str(tmp_path / "topics")).orderBy("offset")
    assert [row.value for row in records.collect()] == texts


@pytest.mark.parametrize("sizes", [[1, 51, 400], [400, 51, 1], [0, 7, 0, 7]])
def test_offsets_follow_the_names_of_files(spark, tmp_path, sizes):
    source, topics = tmp_path / "lines", tmp_path / "topics"
    source.mkdir()
    texts = []
    for number, size in enumerate(sizes):
        lines = [f"P,{number} {i}" for i in range(size)]
        (source / f"day {number}.csv").write_text("".join(text + "\n" for text in lines))
        texts += lines
    publish_files(spark, str(source), str(topics), "sensor")
    publish_files(spark, str(source), str(topics), "sensor")
    records = read_topic(spark, str(topics)).orderBy("offset").collect()
    assert [row.value for row in records] == texts * 2
    assert len({row.offset for row in records}) == len(records)


def test_subscription_to_several_topics(spark, tmp_path):
    send(spark, tmp_path, ["a,1"], topic="one")
    send(spark, tmp_path, ["b,1", "b,2"], topic="two")
    send(spark, tmp_path, ["c,1"], topic="three")
    records = read_topic(spark, str(tmp_path), "two,one,two")
    found = sorted((row.topic, row.value) for row in records.collect())
    assert found == [("one", "a,1"), ("two", "b,1"), ("two", "b,2")]


def test_topic_names():
    assert topic_names("b,a,b") == ["a", "b"]
    for bad in ("", "a,", "a/b", "{a}", "a b"):
        with pytest.raises(ValueError):
            topic_names(bad)


def test_kafka_options():
    stream = read_options("host:9092", "b,a", streaming=True, records_per_batch=10)
    assert stream["subscribe"] == "a,b"
    assert stream["startingOffsets"] == "earliest"
    assert stream["maxOffsetsPerTrigger"] == "10"
    assert "endingOffsets" not in stream
    # A busy key's topic partition is split over tasks.
    assert int(stream["maxRecordsPerPartition"]) > 0
    batch = read_options("host:9092", "a", streaming=False)
    assert batch["endingOffsets"] == "latest"
