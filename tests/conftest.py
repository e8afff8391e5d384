"""One local session for all tests; its working tables go to a folder of the test run."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import FOLDER  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from orderweave.session import build_session

    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="orderweave-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tables(spark):
    from orderweave.sources.driver_tables import DriverTables

    return DriverTables(spark, FOLDER)
