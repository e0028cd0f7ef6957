import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from zonelens.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def tmp_out(spark):
    from zonelens.session import scratch_path
    return scratch_path(spark, "test")
