import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from loomquill.session import local_session, ship

    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def data():
    if not DATA.exists():
        pytest.skip("no test tables")
    return str(DATA)
