import pytest

from almanac.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        8,
        4,
        **{
            "spark.checkpoint.dir": str(shared / "checkpoints"),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
