import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from presswerk.session import build_session

    session = build_session("local[4]", 4, "3g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("the driver's tables are not here")
    return folder
