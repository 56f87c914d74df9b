import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tether.session import local_session, ship

    session = local_session(8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
