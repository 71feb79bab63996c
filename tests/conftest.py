import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from skriftverk.session import build_session, ship

    s = build_session("4", 4, spark__ui__showConsoleProgress="false", driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
