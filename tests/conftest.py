import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tideline.session import local_session  # noqa: E402

SAMPLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample():
    if not os.path.isdir(SAMPLE):
        pytest.skip("sample tables are not here")
    return SAMPLE


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
