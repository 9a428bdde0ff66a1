import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fairstream.session import get_session, shared_dir
    s = get_session("local[4]", shuffle_partitions=8, app_name="fairstream-tests")
    shared_dir(s)     # registers a temp checkpoint folder only if none is configured
    yield s
    s.stop()
