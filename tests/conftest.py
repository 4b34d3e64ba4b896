import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=4)
    yield session
    session.stop()
