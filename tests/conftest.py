import pytest

from ledgerleaf.session import local_session

SMALL_TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=4, checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL_TABLES
