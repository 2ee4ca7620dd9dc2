"""Limited scans over key ranges, claims, files by day, statistics of changed days."""

import re
from pathlib import Path

import pytest
from helpers import frame, line, rows, table
from pyspark.sql import functions as F

from gaugeflow.functions import parse_sensor
from gaugeflow.operators import wide_table
from gaugeflow.plans.jobs import write_daily_stats
from gaugeflow.sources import storage


def put(spark, made, lines, first_offset=0, run="first", batch=0):
    lines = frame(spark, lines, offsets=True)
    lines = lines.withColumn("offset", F.col("offset") + first_offset)
    made.put_readings(parse_sensor(lines, keep=("offset",)), run, batch)


def day(number):
    return f"{1 + number // 28}/{1 + number % 28}/24"


def readings(days, sensors=("a", "b"), times=("0:00", "9:30"), psi=1.0):
    return [line(resid=s, date=d, time=t, psi=psi) for d in days for s in sensors for t in times]


def full_scan(made, family, limit):
    return [tuple(r) for r in made.family(family).orderBy("rowkey").limit(limit).collect()]


def first_rows(made, family, limit):
    return [tuple(r) for r in made.scan_family(family, limit).collect()]


def files_read(made, family, limit):
    return [f for f in made.scan_family(family, limit).inputFiles() if f"/{family}/" in f]


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """Two hundred days in a base, then a tail on some of them."""
    made = table(spark, tmp_path_factory.mktemp("wide"))
    put(spark, made, readings([day(i) for i in range(200)]))
    for family in ("data", "alert"):
        made.compact(family, idle=True)
    return made


def test_a_limited_scan_reads_few_of_the_base_files(spark, wide):
    files = list(Path(wide.folder("alert")).rglob("day=*/*.parquet"))
    assert len(files) >= 200
    for limit in (1, 5, 50):
        assert first_rows(wide, "alert", limit) == full_scan(wide, "alert", limit)
        assert len(files_read(wide, "alert", limit)) <= limit
    assert first_rows(wide, "alert", 10_000) == full_scan(wide, "alert", 10_000)
    wide_rows = [tuple(r) for r in wide.scan_wide(7).collect()]
    assert wide_rows == [tuple(r) for r in wide.scan_wide().limit(7).collect()]


def test_a_limited_scan_with_a_tail(spark, wide):
    put(spark, wide, readings([day(3), day(199), "0/1/24"], ("a", "_early", "z"), ("0:00", "23:59"), psi=2.0), 5000, batch=1)
    assert len(files_read(wide, "alert", 5)) < 30
    for limit in (1, 5, 50, 403, 405, 100_000):
        for family in ("data", "alert"):
            assert first_rows(wide, family, limit) == full_scan(wide, family, limit)
    wide.compact("alert", idle=True)  # rewrites the days of the tail only
    assert len(list(Path(wide.root, "_ranges", "alert").glob("base=*"))) == 2
    assert len(files_read(wide, "alert", 50)) <= 50
    for limit in (1, 50, 405):
        assert first_rows(wide, "alert", limit) == full_scan(wide, "alert", limit)


def test_a_base_without_ranges_and_very_large_limits(spark, tmp_path, monkeypatch):
    made = table(spark, tmp_path)
    put(spark, made, readings([day(i) for i in range(5)]))
    made.compact("data", idle=True)
    storage.delete(spark, f"{made.root}/_ranges")  # as after a job lost before it wrote them
    assert first_rows(made, "data", 3) == full_scan(made, "data", 3)
    put(spark, made, readings([day(2), day(9)], psi=8.0), 100, batch=1)
    made.compact("data", idle=True)  # now some days have ranges
    for limit in (1, 6, 50):
        assert first_rows(made, "data", limit) == full_scan(made, "data", limit)
    monkeypatch.setattr(wide_table, "_RANGE_ROWS", 2)
    for limit in (1, 2, 6):
        assert first_rows(made, "data", limit) == full_scan(made, "data", limit)


# Claims


def test_an_outdated_listing_gives_no_number_twice(spark, tmp_path, monkeypatch):
    made = table(spark, tmp_path)
    monkeypatch.setattr(storage, "folders", lambda *_: [])
    monkeypatch.setattr(storage, "claimed", lambda *_: [])
    assert made._place_of_run("one", None) == 0
    assert made._place_of_run("two", None) == 1
    monkeypatch.undo()
    assert [(place, run) for place, run, _ in made._known_runs()] == [(0, "one"), (1, "two")]
    assert [storage.claim(spark, f"{made.root}/x", first) for first in (0, 0, 7, 0)] == [0, 1, 7, 8]


def test_one_new_run_has_one_place_and_one_owner(spark, tmp_path, monkeypatch):
    made = table(spark, tmp_path)
    known = made._known_runs
    looks = iter([[], None, [], None])
    monkeypatch.setattr(wide_table.WideTable, "_known_runs", lambda _: known() if (x := next(looks)) is None else x)
    assert made._place_of_run("same", "owner1") == 0
    with pytest.raises(ValueError, match="another checkpoint"):  # it looked before the first was there
        made._place_of_run("same", "owner2")
    monkeypatch.undo()
    assert made._known_runs() == [(0, "same", "owner1")]


def test_two_compactions_and_two_statistics_share_no_folder(spark, tmp_path, monkeypatch):
    made = table(spark, tmp_path)
    put(spark, made, readings([day(0)]))
    expected = rows(made.family("data"))
    deleted = []
    with monkeypatch.context() as m:
        m.setattr(storage, "delete", lambda _, path: deleted.append(path))  # both lost before they deleted
        m.setattr(storage, "claimed", lambda *_: [])
        made.compact("data", idle=True)
        made.compact("data", idle=True)
        made.put_stats(*stats_of(made))
        made.put_stats(*stats_of(made))
    bases = {b for run, b in made._batches("data") if run == "0base"}
    assert bases == {0, 1} and rows(made.family("data")) == expected
    assert {b for _, b in made._batches("stats")} == {0, 1}
    made.compact("data", idle=True)
    assert rows(made.family("data")) == expected
    assert {b for run, b in made._batches("data") if run == "0base"} == {2}


def stats_of(made):
    from gaugeflow.operators import daily_stats, sensor_rows

    return (daily_stats(sensor_rows(made.family("data"))),)


# Files by day


def test_a_backlog_of_many_days_writes_few_files(spark, tmp_path):
    made = table(spark, tmp_path)
    lines = frame(spark, readings([day(i) for i in range(30)], [f"s{i}" for i in range(20)]), offsets=True)
    made.put_readings(parse_sensor(lines.repartition(8), keep=("offset",)), "first", 0)
    for family in ("data", "alert"):
        folder = Path(made.folder(family), "run=first", "batch=0")
        files = [f for f in folder.rglob("*.parquet")]
        assert len(list(folder.glob("day=*"))) == 30 and len(files) < 60
    stored = made.versions("data").select("rowkey", "day")
    assert stored.count() == stored.select("rowkey").distinct().count() == 1200
    right = F.col("day") == wide_table.day_folder()
    assert stored.where(~right).count() == 0


def test_a_busy_day_is_split_over_tasks(spark, tmp_path):
    made = table(spark, tmp_path)
    lines = spark.range(40_000).select(
        F.col("id").alias("offset"),
        F.concat(F.lit("s"), F.col("id") % 977, F.lit(",1/1/24,"), F.col("id"), F.lit(",1.5,2,3,4,9,"), F.col("id")).alias("value"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "200k")
    try:
        made.put_readings(parse_sensor(lines.repartition(6), keep=("offset",)), "first", 0)
    finally:
        spark.conf.unset(size)
    files = list(Path(made.folder("data")).rglob("*.parquet"))
    assert len({f.parent for f in files}) == 1 and len(files) > 3
    assert made.family("data").count() == 40_000


def test_few_rows_of_many_days_are_written_by_several_tasks(spark, tmp_path):
    made = table(spark, tmp_path)
    lines = spark.range(12000).select(
        F.col("id").alias("offset"),
        F.concat_ws(
            ",", F.concat(F.lit("s"), F.col("id") % 97), F.concat(F.lit("1/"), F.col("id") % 60, F.lit("/24")),
            F.col("id"), *[F.pmod(F.xxhash64("id", F.lit(m)), F.lit(64)) / 16 for m in range(6)],
        ).alias("value"),
    )
    made.put_readings(parse_sensor(lines, keep=("offset",)), "first", 0)
    version = write_daily_stats(made)
    for family, run, batch in (("alert", "first", 0), ("stats", "stats", version)):
        files = list(Path(made.folder(family), f"run={run}", f"batch={batch}").rglob("*.parquet"))
        assert len(files) == 60 and len({f.name[:10] for f in files}) > 1
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize") in ("1MB", "1048576b")
    assert stats_rows(made) == full_stats(spark, made)


def test_many_days_are_listed_in_few_tasks(spark, tmp_path):
    made, context = table(spark, tmp_path), spark.sparkContext
    put(spark, made, readings([day(i) for i in range(60)], times=("0:00",)))
    context.setJobGroup("listing", "listing")
    try:
        versions = made.versions("data")
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            context.setLocalProperty(name, None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    tasks = [tracker.getStageInfo(stage).numTasks for stage in stages]
    assert tasks and max(tasks) <= 2 * context.defaultParallelism
    assert versions.count() == 120


# Statistics of changed days


def test_a_batch_of_wanted_days_is_one_folder(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, readings([day(i) for i in range(4)]))
    put(spark, made, readings([day(1), day(2)], psi=7.0), 100, batch=1)
    days = {"d1-2-24", "d1-3-24"}
    found = [f.removeprefix(made.folder("data")) for f in made.folders("data", days)]
    assert sorted(found) == [
        "/run=first/batch=0/day=d1-2-24", "/run=first/batch=0/day=d1-3-24", "/run=first/batch=1"
    ]
    wanted = F.col("rowkey").rlike("_1/[23]/24 ")
    assert rows(made.family("data", days)) == rows(made.family("data").where(wanted))
    assert made.family("data", {"d9-9-99"}).count() == 0


def test_a_batch_replaced_while_it_is_read_brings_no_other_days(spark, tmp_path, monkeypatch):
    made = table(spark, tmp_path)
    put(spark, made, readings([day(1)]))
    put(spark, made, readings([day(1), day(2)], psi=7.0), 100, batch=1)
    whole = [f"{made.folder('data')}/run=first/batch={batch}" for batch in (0, 1)]
    monkeypatch.setattr(wide_table.WideTable, "folders", lambda *_: whole)  # listed before the retry
    assert {r["rowkey"].split()[0][2:] for r in made.family("data", {"d1-2-24"}).collect()} == {day(1)}


def stats_rows(made):
    return rows(made.family("stats"))


def full_stats(spark, made):
    from gaugeflow.operators import stats_cells

    return rows(stats_cells(*stats_of(made)))


def days_read(spark, made):
    """Day folders of data that the next statistics would read."""
    days = made.changed_days(made.finished_batches())
    files = made.family("data", days).inputFiles()
    return {re.search(r"/day=([^/]+)/", f)[1] for f in files}


def test_statistics_read_changed_days_only(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, readings([day(i) for i in range(6)]))
    first = write_daily_stats(made, changed=True)  # the first ones read all
    assert stats_rows(made) == full_stats(spark, made)
    assert write_daily_stats(made, changed=True) == first  # nothing new
    # A late reading of an old day, a repeated key, a new day.
    put(spark, made, readings([day(1), day(9)], times=("0:00", "0:07"), psi=77.0), 100, batch=1)
    assert days_read(spark, made) == {"d1-2-24", "d1-10-24"}
    second = write_daily_stats(made, changed=True)
    assert second > first and stats_rows(made) == full_stats(spark, made)
    written = {r["rowkey"] for r in made.batch_rows("stats", "stats", second).collect()}
    assert written == {f"{s}_{d}" for s in "ab" for d in (day(1), day(9))}
    # A replay under a new run repeats versions; its days are read again, to no effect.
    put(spark, made, readings([day(2)]), 8, run="again", batch=0)
    assert days_read(spark, made) == {"d1-3-24"}
    write_daily_stats(made, changed=True)
    assert stats_rows(made) == full_stats(spark, made)


def test_compaction_neither_hides_nor_invents_changes(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, readings([day(i) for i in range(4)]))
    write_daily_stats(made, changed=True)
    made.compact("data", idle=True)
    assert made.changed_days(made.finished_batches()) == set()
    put(spark, made, readings([day(2)], psi=50.0), 100, batch=1)
    made.compact("data", idle=True)  # merged before any statistics saw it
    put(spark, made, readings([day(3)], psi=60.0), 200, batch=2)
    made.compact("data", idle=True)
    assert made.changed_days(made.finished_batches()) == {"d1-3-24", "d1-4-24"}
    write_daily_stats(made, changed=True)
    assert stats_rows(made) == full_stats(spark, made)
    assert made.changed_days(made.finished_batches()) == set()
    made.truncate()
    assert made.changed_days({}) is None and stats_rows(made) == []


def test_a_retried_or_unfinished_batch_counts_as_changed(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, readings([day(0), day(1)]))
    write_daily_stats(made, changed=True)
    mark = Path(made.folder("data"), "run=first", "batch=0", "_SUCCESS")
    put(spark, made, readings([day(0)], psi=3.0))  # the same batch once more
    assert made.changed_days(made.finished_batches()) == {"d1-1-24"}
    write_daily_stats(made, changed=True)
    mark.unlink()  # as if it were still being written
    assert made.changed_days(made.finished_batches()) == {"d1-1-24"}
    write_daily_stats(made, changed=True)
    assert made.changed_days(made.finished_batches()) == {"d1-1-24"}
