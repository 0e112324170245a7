import pytest

from marketloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, "tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    yield session
    session.stop()
