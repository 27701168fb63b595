import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sparktab.session import local_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 8)


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"
