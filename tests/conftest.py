import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from listenhouse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=min(8, os.cpu_count() or 1))
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
