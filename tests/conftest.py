import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("COLFORGE_TEST_SF", "/root/testdata/sf0.001")
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from colforge.session import local_session_for_tests
    s = local_session_for_tests(8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
