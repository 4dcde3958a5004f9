import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomspan.session import local_session  # noqa: E402

DATA = "/root/testdata/"


@pytest.fixture(scope="session")
def spark():
    return local_session(os.environ.get("TEST_CPUS", "8"), 4, "4g")


@pytest.fixture(scope="session")
def small():
    return DATA + "sf0.001"


@pytest.fixture(scope="session")
def medium():
    return DATA + "sf0.01"
