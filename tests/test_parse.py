"""The strict, eager parse."""

import math

import pytest
from helpers import frame, line
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeflow.functions import parse_sensor
from gaugeflow.operators import (
    avg_psi,
    low_pressure,
    reading_count,
    received_count,
    sensor_sql,
)
from gaugeflow.schemas import SENSOR

GOOD = "a,d,t,1,2,3,4,5,6"
BAD = {
    "letters": "a,d,t,BAD,2,3,4,5,6",
    "empty_middle": "a,d,t,1,2,,4,5,6",
    "empty_last": "a,d,t,1,2,3,4,5,",
    "short": "a,d,t,1,2",
    "eight": "a,d,t,1,2,3,4,5",
    "blank": "",
    "null": None,
    "quoted": '"a,b",c,t,1,2,3,4,5,6',
    "lower_inf": "a,d,t,inf,2,3,4,5,6",
    "lower_nan": "a,d,t,1,2,3,4,nan,6",
    "lower_infinity": "a,d,t,1,2,3,4,5, -infinity ",
    "mixed_literals": "a,d,t,NaN,2,3,4,5,Inf",
}
USES = {
    "all": lambda s: s,
    "one_column": lambda s: s.select("resid"),
    "count": received_count,
    "grouped_count": reading_count,
    "grouped_mean": avg_psi,
    "filter": low_pressure,
    "filter_other_column": lambda s: s.where("resid = 'nobody'"),
    "filter_kept_column": lambda s: s.where("offset = 0"),
    "kept_column": lambda s: s.select("offset"),
    "sql": lambda s: sensor_sql(s, "SELECT count(*) AS n FROM sensor"),
}


def parsed(spark, text):
    return parse_sensor(frame(spark, [text])).first()


def test_schema(spark):
    result = parse_sensor(frame(spark, [GOOD]))
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in SENSOR
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        (GOOD, ("a", "d", "t", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)),
        (GOOD + ",7,8", ("a", "d", "t", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)),
        (",,,1,2,3,4,5,6", ("", "", "", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)),
        ("a,d,t, 1.5 ,2d,3f,0x1p3,1e1,-6", ("a", "d", "t", 1.5, 2, 3, 8, 10, -6)),
        (
            "a,d,t,Infinity,-Infinity,3,4,1e999,6",
            ("a", "d", "t", math.inf, -math.inf, 3.0, 4.0, math.inf, 6.0),
        ),
        ('"a",d,inf,1,2,3,4,5,6', ('"a"', "d", "inf", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)),
    ],
)
def test_accepted(spark, text, expected):
    assert tuple(parsed(spark, text)) == expected


def test_nan_is_a_number_but_no_alert(spark):
    sensor = parse_sensor(frame(spark, ["a,d,t,1,2,3,4,NaN,6"]))
    assert math.isnan(sensor.first().psi)
    assert low_pressure(sensor).isEmpty()


def test_alert_threshold_is_strict(spark):
    lines = [line(psi=5.0), line(psi=4.9375), line(psi=5.0625)]
    alerts = low_pressure(parse_sensor(frame(spark, lines)))
    assert [row.psi for row in alerts.collect()] == [4.9375]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Each bad line in a Parquet file after a good one, where filters push down."""
    paths = {}
    for name, text in BAD.items():
        paths[name] = str(tmp_path_factory.mktemp(name) / "lines")
        frame(spark, [GOOD, text], offsets=True).coalesce(1).write.parquet(paths[name])
    return paths


@pytest.mark.parametrize("name", BAD)
@pytest.mark.parametrize("use", USES)
def test_bad_line_fails_every_use(spark, stored, name, use):
    sensor = parse_sensor(spark.read.parquet(stored[name]), keep=("offset",))
    with pytest.raises(PySparkException, match="malformed sensor line"):
        USES[use](sensor).collect()


@pytest.mark.parametrize("name", ["letters", "empty_last", "null"])
def test_strict_without_ansi(spark, stored, name):
    session = spark.newSession()
    session.conf.set("spark.sql.ansi.enabled", "false")
    sensor = parse_sensor(session.read.parquet(stored[name]))
    with pytest.raises(PySparkException, match="malformed sensor line"):
        sensor.agg(F.count("resid")).collect()


def test_binary_values_parse_after_cast(spark):
    records = frame(spark, [GOOD]).select(F.col("value").cast("binary"))
    records = records.select(F.col("value").cast("string"))
    assert parse_sensor(records).first().psi == 5.0
