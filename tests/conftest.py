import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from billforge.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_spark(os.environ.get("TEST_CPUS", "4"), "4g", "tests")


@pytest.fixture(scope="session")
def data():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path
