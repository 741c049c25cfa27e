import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from locusloom.session import local_session

    session = local_session("locusloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def sf_dir():
    return SF_DIR
