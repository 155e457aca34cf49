import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL_SF = os.environ.get("SITECALL_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from sitecall.session import local_session

    s = local_session("*", shuffle_partitions=8, app="sitecall-tests")
    yield s


@pytest.fixture(scope="session")
def sf():
    return SMALL_SF
