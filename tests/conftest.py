import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tabkit.session import get_spark

    s = get_spark(cpus=4, app="tabkit-tests")
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE
