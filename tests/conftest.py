import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hexmosaic.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("8", 4, "6g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
