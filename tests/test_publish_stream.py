"""Publishing files as they arrive, bounded drains, counts taken in the pass."""

import pytest
from helpers import line, rows, send
from pyspark.errors import StreamingQueryException

from gaugeflow.plans.jobs import publish_files
from gaugeflow.sources import storage
from gaugeflow.sources.lines import stream_lines
from gaugeflow.sources.topic import publish, read_topic, segment_of
from gaugeflow.streaming import (
    RECEIVED,
    drain,
    drain_counts,
    drain_total,
    read_report,
    stream_reports,
    stream_to_topic,
)
from gaugeflow.streaming import publish as publishing


def deliver(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("".join(f"{text}\n" for text in lines))
    (folder / f".{name}").rename(folder / name)


def run(spark, tmp_path, checkpoint="checkpoint", topic="sensor", files=None):
    lines = stream_lines(spark, str(tmp_path / "lines"), files)
    stream_to_topic(lines, str(tmp_path / "topics"), topic, str(tmp_path / checkpoint)).awaitTermination()


def values(spark, tmp_path, topic="sensor"):
    records = read_topic(spark, str(tmp_path / "topics"), topic)
    return [r["value"] for r in records.orderBy("offset").collect()]


def test_files_are_published_once_in_their_order(spark, tmp_path):
    texts = {f"{n}.csv": [line(resid=f"r{n}{i}") for i in range(30)] for n in (2, 1, 4, 3)}
    for name in ("2.csv", "1.csv"):
        deliver(tmp_path / "lines", name, texts[name])
    run(spark, tmp_path)
    assert values(spark, tmp_path) == texts["1.csv"] + texts["2.csv"]
    run(spark, tmp_path)  # nothing new
    for name in ("4.csv", "3.csv"):
        deliver(tmp_path / "lines", name, texts[name])
    run(spark, tmp_path)
    whole = [text for name in sorted(texts) for text in texts[name]]
    assert values(spark, tmp_path) == whole
    publish_files(spark, str(tmp_path / "lines"), str(tmp_path / "once"), "sensor")
    at_once = read_topic(spark, str(tmp_path / "once")).orderBy("offset").collect()
    assert [(r["key"], r["value"]) for r in at_once] == [(text.split(",")[0], text) for text in whole]


def test_a_publisher_killed_before_its_commit_goes_on(spark, tmp_path, monkeypatch):
    deliver(tmp_path / "lines", "1.csv", [line(resid="a")])
    run(spark, tmp_path)
    deliver(tmp_path / "lines", "2.csv", [line(resid="b"), line(resid="c")])

    def lost(*args):
        publish(*args)  # the records are there, the batch is not committed
        raise RuntimeError("lost")

    monkeypatch.setattr(publishing, "publish", lost)
    with pytest.raises(StreamingQueryException, match="lost"):
        run(spark, tmp_path)
    monkeypatch.undo()
    # Another publisher comes first.
    other = send(spark, tmp_path / "topics", [line(resid="z")])
    deliver(tmp_path / "lines", "3.csv", [line(resid="d")])
    run(spark, tmp_path)
    assert sorted(t[0] for t in values(spark, tmp_path)) == ["a", "b", "c", "d", "z"]
    segments = [segment_of(spark, str(tmp_path / "topics"), "sensor", "me", batch) for batch in (0, 0, 1)]
    assert segments[0] == segments[1] and segments[2] == segments[0] + 1 and other < segments[0]


def test_two_publishers_and_an_unnamed_segment_share_no_number(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "topics")
    taken = [segment_of(spark, root, "sensor", owner, 0) for owner in ("one", "two")]
    monkeypatch.setattr(storage, "claimed", lambda *_: [])  # an outdated listing
    taken.append(send(spark, root, [line()]))
    taken.append(segment_of(spark, root, "sensor", "three", 0))
    assert taken == [0, 1, 2, 3]


def test_a_drain_stops_after_polls_or_time_and_goes_on(spark, tmp_path):
    root, out, checkpoint = str(tmp_path / "topics"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for n in range(4):
        send(spark, root, [line(resid=f"r{i}") for i in range(n + 1)])

    def records():
        return read_topic(spark, root, streaming=True, files_per_batch=1)

    assert drain(records(), out, "r", checkpoint, polls=0) == 0
    assert drain(records(), out, "r", checkpoint, polls=3) == 3
    assert rows(drain_counts(spark, out, "r")) == [(0, 1), (1, 2), (2, 3)]
    assert drain(records(), out, "r", checkpoint, seconds=0) == 0
    assert drain(records(), out, "r", checkpoint, polls=9, seconds=600) == 1
    assert rows(drain_total(spark, out, "r")) == [(10,)]
    with pytest.raises(StreamingQueryException):
        drain(records().selectExpr("raise_error('broken') AS x").where("x IS NULL"), out, "s", str(tmp_path / "c2"))


def test_received_counts_all_records_of_any_report(spark, tmp_path):
    root = str(tmp_path / "topics")
    send(spark, root, [line(resid=f"r{i % 3}") for i in range(7)])
    few = {"some": lambda sensor: sensor.limit(2)}
    more = {**few, "more": lambda sensor: sensor.groupBy("resid").count()}
    for number, options in enumerate(({}, {"reports": few}, {"reports": more})):
        out, checkpoint = str(tmp_path / f"out{number}"), str(tmp_path / f"checkpoint{number}")
        stream_reports(read_topic(spark, root, streaming=True), out, "r", checkpoint, **options).awaitTermination()
        assert rows(read_report(spark, out, RECEIVED, "r", "received bigint")) == [(7, 0)]
