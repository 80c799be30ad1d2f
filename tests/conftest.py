import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from spanshade.session import local_session
    s = local_session("*", shuffle_partitions=8, app="spanshade-tests")
    yield s
    s.stop()


@pytest.fixture
def tmpdir_new(tmp_path):
    return str(tmp_path)
