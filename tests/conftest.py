import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def pytest_configure(config):
    config.addinivalue_line("markers", "slow: fits whole searches or large forests; leave out with -m 'not slow'")


@pytest.fixture(scope="session")
def spark():
    from tabula.session import get_spark
    s = get_spark("local[4]", app="tabula-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    """A fresh folder under the session's checkpoint folder."""
    from tabula.session import scratch_path
    return scratch_path(spark, "test")
