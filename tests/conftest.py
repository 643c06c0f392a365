import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.session import local_session  # noqa: E402
from riskloom.session import configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = configure(local_session("tests", 4))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL
