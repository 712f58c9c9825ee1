import pytest

from ledgerloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    import os

    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return SMALL
