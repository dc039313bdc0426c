import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetlens.context import RunContext  # noqa: E402
from fleetlens.session import build_session  # noqa: E402

AS_OF = datetime(2024, 1, 30, 23, 58, 0)


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="fleetlens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def ctx():
    return RunContext(as_of=AS_OF)
