import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from casegrid.session import get_session
    s = get_session("local[4]", 4, app_name="casegrid-tests")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
