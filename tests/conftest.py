import pytest

from gridloom.session import local_session
from gridloom.sources.scratch import clear_scratch


@pytest.fixture(scope="session")
def spark():
    session = local_session("gridloom-tests")
    yield session
    clear_scratch(session)
    session.stop()
