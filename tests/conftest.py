import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.path.join(ROOT, "tests", "data")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from refmart.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="refmart-test-", dir="/tmp")
