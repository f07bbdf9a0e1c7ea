from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postlake.session import local_session, run_folder  # noqa: E402
from postlake.tables import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("postlake-tests", cores="8", **{"spark.driver.memory": "6g"})
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return run_folder(spark, "test")


@pytest.fixture
def lake(spark, folder):
    return Lake(spark, f"{folder}/lake")
