from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from geofleet.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[*]", app_name="geofleet-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="geofleet-test-ckpt-"))
    yield session


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="geofleet-test-")


def ntz(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)
