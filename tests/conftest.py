import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from vitalis.session import build_session

    session = build_session("local[8]", "vitalis-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session
