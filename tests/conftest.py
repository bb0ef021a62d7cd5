import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tableflow.session import new_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = new_session("tableflow-tests", "local[8]", shuffle_partitions=2, driver_memory="8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def table_path(tmp_path):
    return str(tmp_path / "table")
