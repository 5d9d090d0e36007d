import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from sluice.plans.session import local_session

    s = local_session(cpus="*", shuffle_partitions=8, app="sluice-tests")
    yield s
    s.stop()


SF0001 = "/root/testdata/sf0.001"
