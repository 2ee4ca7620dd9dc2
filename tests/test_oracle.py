"""Every registered query against its SQL on the given tables."""

import math
import os
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SELECTS = contract.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(
            f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')"
        )
    return connection


def comparable(value):
    if isinstance(value, float) and not math.isnan(value):
        return float(f"{value:.12g}")
    return value


def in_order(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(comparable(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], rows


def test_every_query_has_its_sql():
    own = {n.removeprefix("q_") for n in vars(contract) if n.startswith("q_")}
    assert own and own <= set(contract.queries()) and own <= set(SELECTS)


@pytest.mark.parametrize("name", sorted(SELECTS))
def test_query_matches_sql(spark, database, name):
    frame = contract.queries()[name](spark, SF_DIR)
    names, rows = in_order(frame.columns, [tuple(row) for row in frame.collect()])
    result = database.execute(SELECTS[name])
    expected_names, expected = in_order(
        [column[0] for column in result.description], result.fetchall()
    )
    assert names == expected_names
    assert len(rows) == len(expected) > 0
    if not re.search(r"ORDER BY \S+( LIMIT \d+)?$", SELECTS[name]):
        rows, expected = sorted(rows, key=repr), sorted(expected, key=repr)
    assert rows == expected


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 280
