import os
import sys
import time

import pytest

# Collected timestamps come back in the local zone of the Python process.
os.environ["TZ"] = "America/Los_Angeles"
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reddwatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", spark__master="local[8]", spark__sql__shuffle__partitions="3",
        spark__default__parallelism="3",
        spark__sql__maxMetadataStringLength="10000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
