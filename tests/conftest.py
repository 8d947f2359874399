import pytest

from babelmill.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session(4, 4, "4g")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()
