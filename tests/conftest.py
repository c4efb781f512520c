import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from helioledger.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = get_session(
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__checkpoint__dir=str(folder / "shared"),
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def rows(frame):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in frame.collect()), key=repr)
