import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="tessera-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL_SF
