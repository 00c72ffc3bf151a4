import pytest

from modelvigil.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, app="modelvigil-tests")
    yield session
    session.stop()
