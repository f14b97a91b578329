import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from demandflow.session import ensure_checkpoint_dir, get_session
    s = get_session("local[8]", shuffle_partitions=8)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
