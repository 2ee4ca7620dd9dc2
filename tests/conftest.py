import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gaugeflow.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "gaugeflow-tests",
        **{
            "spark.master": "local[4]",
            "spark.driver.memory": "4g",
            # Short jobs: quick compilation beats well optimised code.
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
            "spark.sql.shuffle.partitions": "3",
            "spark.default.parallelism": "2",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
