import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session("local[4]", app="tidemark-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
                             "spark.eventLog.enabled": "true", "spark.eventLog.compress": "false",
                             "spark.eventLog.rolling.enabled": "false",
                             "spark.eventLog.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never cleared: each run takes a new one)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"
