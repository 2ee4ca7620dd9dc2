"""The keyed wide table."""

import shutil
from pathlib import Path

import pytest
from helpers import frame, ingest, line, rows, send, table
from pyspark.sql import functions as F

from gaugeflow.functions import parse_sensor
from gaugeflow.operators import wide_table
from gaugeflow.operators import daily_stats, sensor_rows, stats_cells
from gaugeflow.plans.jobs import write_daily_stats
from gaugeflow.schemas import SENSOR_ROW, STATS_CELLS


def put(spark, made, lines, first_offset=0, run="first", batch=0):
    lines = frame(spark, lines, offsets=True)
    lines = lines.withColumn("offset", F.col("offset") + first_offset)
    made.put_readings(parse_sensor(lines, keep=("offset",)), run, batch)


def test_last_write_wins_over_all_cells(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, [line(psi=1.0, hz=10), line(psi=2.0, hz=20)])
    put(spark, made, [line(psi=3.0, hz=30)], first_offset=2, batch=1)
    assert rows(made.family("data"), "rowkey", "hz", "psi") == [
        ("a_1/1/24 0:00", 30.0, 3.0)
    ]


def test_alert_cell_outlives_a_later_normal_reading(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, [line(psi=4.0), line(psi=3.0), line(psi=9.0)])
    assert rows(made.family("data"), "psi") == [(9.0,)]
    assert rows(made.family("alert"), "psi") == [(3.0,)]


def test_batch_without_alerts_and_empty_table(spark, tmp_path):
    made = table(spark, tmp_path)
    for family in ("data", "alert", "stats"):
        assert made.family(family).isEmpty()
        assert made.scan_family(family, 5).isEmpty()
    assert made.scan_wide(5).isEmpty()
    put(spark, made, [line(psi=9.0)])
    assert made.family("alert").isEmpty()


def test_retried_batch_replaces_itself(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, [line(time="0:01"), line(time="0:02", psi=1.0)], batch=4)
    put(spark, made, [line(time="0:01"), line(time="0:03")], batch=4)
    assert rows(made.family("data"), "rowkey") == [
        ("a_1/1/24 0:01",),
        ("a_1/1/24 0:03",),
    ]
    assert made.versions("data").count() == 2
    assert made.family("alert").isEmpty()


def test_rows_do_not_mix_versions_with_nan(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, [line(psi=1.0, hz=1.0), line(psi="NaN", hz=2.0)])
    (row,) = made.family("data").collect()
    assert row.hz == 2.0 and row.psi != row.psi


def test_arrival_order_for_several_topics(spark, tmp_path):
    made = table(spark, tmp_path, by_arrival=True)
    put(spark, made, [line(psi=1.0)], first_offset=900, batch=0)
    put(spark, made, [line(psi=2.0)], first_offset=3, batch=1)
    assert rows(made.family("data"), "psi") == [(2.0,)]
    # A replay under a later run name shows its own values again.
    put(spark, made, [line(psi=1.0)], first_offset=900, run="second", batch=0)
    assert rows(made.family("data"), "psi") == [(1.0,)]
    made.compact("data", idle=True)
    assert rows(made.family("data"), "psi") == [(1.0,)]
    put(spark, made, [line(psi=2.0)], first_offset=3, run="second", batch=1)
    assert rows(made.family("data"), "psi") == [(2.0,)]


def test_run_names_are_checked(spark, tmp_path):
    made = table(spark, tmp_path)
    for run in ("", "0base", "a/b", "A"):
        with pytest.raises(ValueError):
            put(spark, made, [line()], run=run)


def readings(count, hot=0):
    """Readings whose first ``hot`` all have one row key."""
    lines = [line("h", time="9:09", psi=i % 11, hz=i) for i in range(hot)]
    for i in range(hot, count):
        lines.append(line(f"s{i % 5}", f"{i % 3 + 1}/1/24", f"{i % 13}:0", i % 11, i))
    return lines


def brute_force(lines):
    """Families by plain Python: later lines overwrite earlier ones."""
    data, alert = {}, {}
    for text in lines:
        fields = text.split(",")
        key = f"{fields[0]}_{fields[1]} {fields[2]}"
        data[key] = tuple(float(value) for value in fields[3:9])
        if data[key][4] < 5.0:
            alert[key] = data[key][4]
    return data, alert


def as_dict(frame):
    return {row[0]: tuple(row[1:]) for row in frame.collect()}


@pytest.mark.parametrize("hot", [0, 200])
def test_families_against_brute_force(spark, tmp_path, hot):
    lines = readings(600, hot)
    made = table(spark, tmp_path)
    for batch in range(3):
        part = lines[batch * 200 : batch * 200 + 200]
        put(spark, made, part, first_offset=batch * 200, batch=batch)
    data, alert = brute_force(lines)
    assert as_dict(made.family("data")) == data
    assert as_dict(made.family("alert")) == {k: (v,) for k, v in alert.items()}
    assert made.row_count().first().rows == len(data)

    write_daily_stats(made)
    days = {}
    for key, cells in data.items():
        days.setdefault(key.split(" ")[0], []).append(cells)
    expected = {
        day: tuple(
            pytest.approx(value)
            for measure in zip(*group)
            for value in (max(measure), min(measure), sum(measure) / len(measure))
        )
        for day, group in days.items()
    }
    assert as_dict(made.family("stats")) == expected


@pytest.fixture(scope="module", params=["batches", "compacted"])
def scanned(request, spark, tmp_path_factory):
    """A table with a hot row key, and the readings it was made from."""
    lines = readings(600, hot=200)
    made = table(spark, tmp_path_factory.mktemp("scanned"))
    for batch in range(2):
        part = lines[batch * 300 : batch * 300 + 300]
        put(spark, made, part, first_offset=batch * 300, batch=batch)
    write_daily_stats(made)
    if request.param == "compacted":
        for family in ("data", "alert", "stats"):
            made.compact(family, idle=True)
    return made, lines


@pytest.mark.parametrize("limit", [1, 50, 10_000])
def test_limited_scans_are_exact(scanned, limit):
    made, lines = scanned
    data, alert = brute_force(lines)
    keys = [row.rowkey for row in made.scan_family("alert", limit).collect()]
    assert keys == sorted(alert)[:limit]
    stats = {key.split(" ")[0] for key in data}
    wide = made.scan_wide(limit).collect()
    assert [row.rowkey for row in wide] == sorted({*data, *stats})[:limit]
    for row in wide:
        assert row.data_psi == data.get(row.rowkey, (None,) * 6)[4]
        assert row.alert_psi == alert.get(row.rowkey)
        assert (row.stats_hzmax is not None) == (row.rowkey in stats)


def test_full_scans_are_ordered(spark, tmp_path):
    lines = readings(300)
    made = table(spark, tmp_path)
    put(spark, made, lines)
    data, _ = brute_force(lines)
    assert [row.rowkey for row in made.scan_family("data").collect()] == sorted(data)
    assert [row.rowkey for row in made.scan_wide().collect()] == sorted(data)


def test_keys_scan_in_byte_order(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, [line(r) for r in ("é", "z", "Z", "0", "\U0001f600", "￮")])
    keys = [row.rowkey[0] for row in made.scan_family("data", 6).collect()]
    assert keys == sorted(keys, key=lambda key: key.encode())


def test_stats_keep_days_a_later_run_lacks(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, [line("a", psi=1.0), line("b", psi=2.0)])
    assert write_daily_stats(made) == 0
    made_again = table(spark, tmp_path / "other")
    put(spark, made_again, [line("a", psi=7.0)])
    stats = daily_stats(sensor_rows(made_again.family("data")))
    assert made.put_stats(stats) == 1
    assert rows(made.family("stats"), "rowkey", "psimax") == [
        ("a_1/1/24", 7.0),
        ("b_1/1/24", 2.0),
    ]


def test_stats_rows_never_feed_back(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, readings(100))
    write_daily_stats(made)
    before = as_dict(made.family("stats"))
    write_daily_stats(made)
    assert as_dict(made.family("stats")) == before
    assert made.row_count().first().rows == made.family("data").count()


def test_stats_versions_grow_over_compaction(spark, tmp_path):
    made = table(spark, tmp_path)
    put(spark, made, [line(psi=1.0)])
    write_daily_stats(made)
    write_daily_stats(made)
    made.compact("stats", idle=True)
    put(spark, made, [line(time="0:01", psi=8.0)], first_offset=1, batch=1)
    assert write_daily_stats(made) == 2
    assert rows(made.family("stats"), "psimax") == [(8.0,)]


def test_sensor_rows_schema(spark, tmp_path):
    found = sensor_rows(table(spark, tmp_path).family("data")).schema
    assert [(f.name, f.dataType) for f in found] == [
        (f.name, f.dataType) for f in SENSOR_ROW
    ]


def test_stats_must_have_the_stats_schema(spark):
    with pytest.raises(TypeError):
        stats_cells(spark.createDataFrame([("a", 1.0)], "rowkey string, maxhz double"))


def test_stats_cell_names(spark, tmp_path):
    made = table(spark, tmp_path)
    assert made.family("stats").columns == ["rowkey", *STATS_CELLS]
    assert STATS_CELLS[:3] == ("hzmax", "hzmin", "hzavg")


def test_compaction_keeps_the_rows_and_sorts_them(spark, tmp_path):
    lines = readings(600, hot=200)
    made = table(spark, tmp_path)
    for batch in range(3):
        part = lines[batch * 200 : batch * 200 + 200]
        put(spark, made, part, first_offset=batch * 200, batch=batch)
    data, alert = brute_force(lines)
    assert made.compact("data", idle=True) == 3
    assert made.compact("alert", idle=True) == 3
    assert made.versions("data").count() == len(data)
    put(spark, made, [line("new")], first_offset=600, batch=3)
    assert made.compact("data", idle=True) == 2
    assert as_dict(made.family("data")).keys() == {*data, "new_1/1/24 0:00"}
    assert as_dict(made.family("alert")) == {k: (v,) for k, v in alert.items()}


def test_compaction_leaves_the_newest_batch_of_a_run(spark, tmp_path):
    made = table(spark, tmp_path)
    assert made.compact("data") == 0
    put(spark, made, [line(time="0:00")], run="run-1", batch=9)
    assert made.compact("data") == 0
    put(spark, made, [line(time="0:01")], run="run-1", batch=10)
    put(spark, made, [line(time="0:02")], run="run-2", batch=0)
    assert made.compact("data") == 1
    assert made.compact("data") == 0
    left = made.versions("data").select("run", "batch").distinct()
    assert rows(left) == [("0base", 0), ("run-1", 10), ("run-2", 0)]
    assert made.family("data").count() == 3


@pytest.mark.parametrize("tail_bytes", [0, 64 << 20])
@pytest.mark.parametrize("by_arrival", [True, False])
def test_base_with_later_batches(spark, tmp_path, monkeypatch, by_arrival, tail_bytes):
    monkeypatch.setattr(wide_table, "_TAIL_BYTES", tail_bytes)
    lines = readings(500, hot=150)
    made = table(spark, tmp_path, by_arrival)
    for batch in range(3):
        part = lines[batch * 100 : batch * 100 + 100]
        put(spark, made, part, first_offset=batch * 100, batch=batch)
    for family in ("data", "alert"):
        made.compact(family)
    for batch in (3, 4):
        part = lines[batch * 100 : batch * 100 + 100]
        put(spark, made, part, first_offset=batch * 100, batch=batch)
    data, alert = brute_force(lines)
    assert as_dict(made.family("data")) == data
    assert as_dict(made.family("alert")) == {k: (v,) for k, v in alert.items()}
    assert made.row_count().first().rows == len(data)
    assert [row.rowkey for row in made.scan_family("data").collect()] == sorted(data)
    write_daily_stats(made)
    assert made.family("stats").count() == len({key.split(" ")[0] for key in data})

    # A replay's first batch repeats old readings after the newer base.
    put(spark, made, lines[:100], run="second", batch=0)
    if by_arrival:
        data.update(brute_force(lines[:100])[0])
    assert as_dict(made.family("data")) == data


def test_a_tail_wins_loses_ties_and_adds_keys_over_a_base(spark, tmp_path):
    made = table(spark, tmp_path)
    times = [f"0:{minute}" for minute in range(6)]
    put(spark, made, [line(time=t, psi=1.0) for t in times[:5]], first_offset=10)
    made.compact("data", idle=True)
    older, newer = [line(time=t, psi=2.0) for t in times[:2]], [line(time=t, psi=3.0) for t in times[1:3]]
    put(spark, made, older, run="replay", batch=0)
    put(spark, made, newer + [line(time=times[5], psi=4.0)] * 3, first_offset=20, batch=1)
    put(spark, made, [line(time=times[3], psi=1.0)], first_offset=13, run="replay", batch=1)
    # A day of the tail alone, and a settled day.
    put(spark, made, [line(date="2/1/24", psi=5.0)], first_offset=90, batch=2)
    expected = [(f"a_1/1/24 {t}", psi) for t, psi in zip(times, (1.0, 3.0, 3.0, 1.0, 1.0, 4.0))]
    expected.append(("a_2/1/24 0:00", 5.0))
    assert rows(made.family("data"), "rowkey", "psi") == expected
    day = {"d1-1-24"}
    assert rows(made.family("data", day), "rowkey", "psi") == expected[:-1]
    made.compact("data", idle=True)
    assert rows(made.family("data"), "rowkey", "psi") == expected


def test_truncate_then_reload(spark, tmp_path):
    made = table(spark, tmp_path / "table")
    send(spark, tmp_path / "topics", readings(50))
    ingest(spark, tmp_path / "topics", made, tmp_path / "c1")
    write_daily_stats(made)
    full = as_dict(made.scan_wide())
    made.truncate()
    assert made.scan_wide().isEmpty()
    ingest(spark, tmp_path / "topics", made, tmp_path / "c2")
    write_daily_stats(made)
    assert as_dict(made.scan_wide()) == full


def files_of(made, family, day):
    return sorted(p.name for p in Path(made.folder(family)).glob(f"run=*/batch=*/day={day}/*.parquet"))


def test_compaction_touches_only_days_of_the_tail(spark, tmp_path):
    made = table(spark, tmp_path)
    days = [f"{month}/1/24" for month in range(1, 7)]
    put(spark, made, [line(date=day, psi=1.0) for day in days])
    made.compact("data", idle=True)
    before = {day: files_of(made, "data", f"d{day.replace('/', '-')}") for day in days}
    put(spark, made, [line(date=days[2], psi=2.0)], first_offset=9, batch=1)
    assert made.compact("data", idle=True) == 2
    after = {day: files_of(made, "data", f"d{day.replace('/', '-')}") for day in days}
    assert [day for day in days if before[day] != after[day]] == [days[2]]
    psi = dict(rows(made.family("data"), "rowkey", "psi"))
    assert psi == {f"a_{day} 0:00": 2.0 if day == days[2] else 1.0 for day in days}


def test_two_bases_of_a_day_are_merged(spark, tmp_path):
    """What a compaction leaves that was lost before its deletes."""
    made = table(spark, tmp_path)
    put(spark, made, [line(psi=1.0), line("b", "2/1/24")])
    made.compact("data", idle=True)
    base = Path(made.folder("data")) / "run=0base"
    shutil.copytree(base / "batch=0" / "day=d1-1-24", base / "batch=1" / "day=d1-1-24")
    assert made.family("data").count() == made.row_count().first().rows == 2
    assert made.compact("data") == 2
    assert made.versions("data").count() == made.family("data").count() == 2


def test_any_text_may_stand_where_the_date_is(spark, tmp_path):
    made = table(spark, tmp_path)
    dates = ["", " ", "_", "a=b", "%2F", "..", "*{}[]", "é" * 300, "x y_z", "__HIVE_DEFAULT_PARTITION__"]
    put(spark, made, [line(date=date, psi=1.0) for date in dates])
    put(spark, made, [line(date=date, psi=2.0) for date in dates], first_offset=99, batch=1)
    expected = sorted((f"a_{date} 0:00", 2.0) for date in dates)
    assert rows(made.family("data"), "rowkey", "psi") == expected
    made.compact("data", idle=True)
    assert rows(made.family("data"), "rowkey", "psi") == expected
    put(spark, made, [line(date="x y_z", psi=3.0)], first_offset=999, batch=2)
    expected = sorted((k, 3.0 if "x y_z" in k else v) for k, v in expected)
    assert rows(made.family("data"), "rowkey", "psi") == expected
