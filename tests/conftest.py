import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """A fresh folder under the session's scratch root."""
    from strata.session import scratch_path
    return scratch_path(spark, "test")


@pytest.fixture()
def local_tmp():
    return tempfile.mkdtemp(prefix="strata-test-")
