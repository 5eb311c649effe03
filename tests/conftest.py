import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from factloom.session import get_session
    s = get_session("factloom-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()
