import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from closecast.session import get_session

    s = get_session(cpus="*", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def snaps(spark):
    from closecast.plans.snapshots import snapshot_table

    return snapshot_table(spark, SF_SMOKE)
