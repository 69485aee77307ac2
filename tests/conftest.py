import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ferrolake.session import local_session
    s = local_session(4, 4, app="ferrolake-tests")
    yield s


SF_SMALL = "/root/testdata/sf0.001"
