import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("TALLYSPARK_DRIVER_MEMORY", "4g")


@pytest.fixture(scope="session")
def spark():
    from tallyspark.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app="tallyspark-tests")
    yield s
    s.stop()
