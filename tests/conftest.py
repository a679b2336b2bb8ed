import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lorefield.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                            spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="lorefield-warehouse-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
