import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pricepanel.session import drop_scratch, get_session
    s = get_session(master="local[4]", shuffle_partitions=4, app_name="pricepanel-tests")
    yield s
    drop_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
