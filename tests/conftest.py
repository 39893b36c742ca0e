import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pressledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=8, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    """Smallest generated test tables."""
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("test tables not present")
    return path
