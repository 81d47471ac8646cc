import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tributary.session import build_session

    session = build_session("tests", "8", 8, "6g")
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
