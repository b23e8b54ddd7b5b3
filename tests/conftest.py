import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from pagewright.session import local_session

    session = local_session(8, 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
