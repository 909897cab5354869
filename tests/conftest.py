from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from harmoniq.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app_name="harmoniq-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from harmoniq.session import scratch_path
    return lambda name="t": scratch_path(spark, name)
