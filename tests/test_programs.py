"""The command line, end to end."""

import pytest
from helpers import line, rows

from gaugeflow.__main__ import main
from gaugeflow.operators import WideTable
from gaugeflow.session import shared_folder, sized_shuffle


def test_programs(spark, tmp_path, capsys):
    source = tmp_path / "sensor.csv"
    source.write_text("\n".join([line("a", psi=1.0), line("a", psi=7.0), line("b")]))
    topics = ["--topics", str(tmp_path / "topics")]
    table = ["--table", str(tmp_path / "table")]

    def stream(name):
        return topics + ["--run", "first", "--checkpoint", str(tmp_path / name)]

    main(["publish", *topics, "--lines", str(source)])
    main(["drain", *stream("c1"), "--out", str(tmp_path / "drain")])
    assert "|       3|" in capsys.readouterr().out

    out = ["--out", str(tmp_path / "reports"), "--bounded"]
    main(["report", *stream("c2"), *out])
    printed = capsys.readouterr().out
    assert "count received 3" in printed and "avgpsi" in printed
    sql = "peak=SELECT max(psi) AS peak FROM sensor"
    main(["report", *stream("c3"), *out, "--sql", sql])
    assert "|peak|" in capsys.readouterr().out

    main(["ingest", *stream("c4"), *table, "--bounded"])
    printed = capsys.readouterr().out
    assert "first records" in printed and "first alert" in printed
    main(["stats", *table])
    printed = capsys.readouterr().out
    assert "avgpsi" in printed and "maxchlPPM: double" in printed
    main(["compact", *table, "--family", "data", "--idle"])
    main(["scan", *table, "--limit", "5"])
    assert "stats_hzmax" in capsys.readouterr().out
    main(["scan", *table, "--family", "alert"])
    assert "a_1/1/24 0:00" in capsys.readouterr().out
    made = WideTable(spark, table[1])
    assert rows(made.family("stats"), "rowkey", "psimax") == [
        ("a_1/1/24", 7.0),
        ("b_1/1/24", 9.0),
    ]
    main(["truncate", *table])
    assert made.scan_wide().isEmpty()


class ClusterSession:
    """The parts of a cluster's session that name the shared folder."""

    master = "spark://host:7077"

    def __init__(self, conf):
        self.conf = conf
        self.sparkContext = self

    def getCheckpointDir(self):
        return None


def test_shared_folder():
    session = ClusterSession({"spark.checkpoint.dir": "/shared/folder/"})
    assert shared_folder(session) == "/shared/folder"
    session = ClusterSession({})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_shuffle_grows_with_the_input(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "8")
    big = tmp_path / "big"
    with big.open("wb") as file:
        file.truncate(4 * 1024**3)
    with sized_shuffle(session, str(tmp_path / "missing")) as partitions:
        assert partitions == 8
    with sized_shuffle(session, str(big)) as partitions:
        assert partitions == 32
        assert session.conf.get("spark.sql.shuffle.partitions") == "32"
    assert session.conf.get("spark.sql.shuffle.partitions") == "8"
