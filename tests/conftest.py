import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from turnloom.runtime import build_session

    s = build_session("local[4]", "turnloom-tests", spark__sql__shuffle__partitions="4", spark__checkpoint__dir=tempfile.mkdtemp(), spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
