from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from sparkmarts.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "8"), app="sparkmarts-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from sparkmarts.sources.store import TableStore

    return TableStore(spark, str(tmp_path / "store"))
