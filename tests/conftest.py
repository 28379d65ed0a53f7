import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from postwave.session import get_session
    # the shared folder comes from spark.checkpoint.dir; get_session sets a
    # local one only when the environment names none
    s = get_session("local[*]", app="postwave-tests", shuffle_partitions=8)
    yield s
    s.stop()
