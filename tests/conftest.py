import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from siltstone.runtime import session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", memory="4g", partitions=4)
    ship(s)
    yield s
    s.stop()
