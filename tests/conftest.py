import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from claimflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("claimflow-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.default.parallelism": "4",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
