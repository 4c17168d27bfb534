import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import clear_scratch, local_session

    s = local_session(master="local[4]", shuffle_partitions=4)
    yield s
    clear_scratch(s)
    s.stop()
