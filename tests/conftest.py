import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from faremill.session import build_session, tune

    session = build_session("tests", "8", shuffle_partitions=4)
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
