from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from casetrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-tests-", dir="/tmp")
    session = build_session("local[4]", app="casetrace-tests", shuffle_partitions=4,
                            extra={"spark.checkpoint.dir": f"{scratch}/checkpoints",
                                   "spark.sql.warehouse.dir": f"{scratch}/warehouse",
                                   "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
