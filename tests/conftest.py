import pytest

from gridpulse.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=8, app="gridpulse-tests", memory="6g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
